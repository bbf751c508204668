"""Exact tokenisation with the ``tokenizers`` library, made fast by encoding
every distinct white-space-delimited chunk once.

A chunk boundary is only used where the tokenizer's own pre-tokenizer always
cuts, so the ids equal those of encoding the whole text:

* ``joined`` (byte-level BPE whose words carry their leading space): a chunk is
  one white-space character plus the following non-space run. Texts with longer
  white-space runs are cut as ``run + word``; texts with other Unicode white
  space are encoded whole.
* ``separate`` (vocabularies that drop white space): cut at blanks and newlines.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RUN_AND_WORD = re.compile(r"\s*\S+|\s+")
_OTHER_SPACE = re.compile(r"[^\S \n\t\r]")
_LAST_SIMPLE = "\u012f"  # up to here letters are single NFC characters with plain lower case
_ENCODERS: dict[tuple, "ChunkEncoder"] = {}


class _Cache(dict):
    """Ids of the first ``room`` distinct chunks; others are made anew each time."""

    def __init__(self, make, room: int):
        super().__init__({"": b""})
        self.make, self.room = make, room

    def __missing__(self, chunk: str) -> bytes | None:
        ids = self.make(chunk)
        if len(self) < self.room:
            self[chunk] = ids
        return ids


class ChunkEncoder:
    """Texts to little-endian unsigned 32-bit ids, with a bounded chunk cache."""

    def __init__(self, path: str, joined: bool, max_cached: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces, self.joined = self.tokenizer.model.tokenize, joined
        self.cache = _Cache(self._chunk, max_cached)
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {i: as_bytes.pre_tokenize_str(chr(i))[0][0] for i in range(0x80, ord(_LAST_SIMPLE) + 1)}
        self.blank = as_bytes.pre_tokenize_str(" ")[0][0]
        self.marks = {c: self._whole(c) for c in ".,;:!?"}
        self.newline = self._whole("\n")

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _chunks(self, texts: pa.Array) -> pa.ListArray:
        """Chunks of every text: cut before blanks and newlines, or at them."""
        if not self.joined:
            return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        marked = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n")
        return pc.split_pattern(marked, "\0")

    def _safe(self, chunk: str) -> bool:
        """May this chunk stand next to any other chunk?"""
        if not self.joined:
            return True
        body = chunk[1:] if chunk[0] in " \n" else chunk
        return body.split() == [body]

    def _word(self, chunk: str) -> bytes | None:
        """Ids of [white space] letters [mark], which the pre-tokenizer cuts into just
        these parts; None for any other chunk."""
        mark = self.marks.get(chunk[-1])
        word, before, lead = chunk[:-1] if mark else chunk, b"", ""
        if self.joined:
            if word[:1] == " ":
                word, lead = word[1:], self.blank
            elif word[:1] == "\n":
                word, before = word[1:], self.newline
        if not word.isalpha():
            return None
        plain = word.isascii()
        if not plain and max(word) > _LAST_SIMPLE:
            return None
        if not self.joined:
            word = word.lower()
        same = " " + word if lead else word  # the same word where no mark or newline is
        ids = None if same == chunk else self.cache.get(same)
        if ids is None:
            ids = array("I", [t.id for t in self.pieces(lead + (word if plain else word.translate(self.letters)))]).tobytes()
            if same != chunk and len(self.cache) < self.cache.room:
                self.cache[same] = ids
        return before + ids + mark if mark else before + ids if before else ids

    def _chunk(self, chunk: str) -> bytes | None:
        ids = self._word(chunk)
        return ids if ids is not None else self._whole(chunk) if self._safe(chunk) else None

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of every text, as the tokenizer gives them for the whole of it. The distinct
        chunks of all texts are looked up once; their ids are then gathered by place. Texts
        with a chunk that may not stand alone, or with the content of an added token, are
        encoded whole."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        lists = self._chunks(texts)
        chunks = lists.flatten().dictionary_encode()
        names = chunks.dictionary  # joined and split: the quickest way to Python strings
        between = "\0" if self.joined else " "
        every = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), between)[0].as_py()
        known = list(map(self.cache.__getitem__, every.split(between) if len(names) else []))
        alone = np.array([k is not None for k in known], bool)
        codes = chunks.indices.to_numpy()
        per_text = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
        whole = np.zeros(len(texts), bool)
        for mark in [*self.added, *(["\0"] if self.joined else [])]:
            whole |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        if not alone.all():
            whole[np.searchsorted(per_text, np.nonzero(~alone[codes])[0], "right") - 1] = True
        ids = np.frombuffer(b"".join(k or b"" for k in known), np.uint32)
        counts = np.fromiter((len(k) if k else 0 for k in known), np.int64, len(known)) // 4
        n = counts[codes]
        ends = np.append(0, np.cumsum(n))
        from_ = (np.cumsum(counts) - counts)[codes] - ends[:-1]
        flat = ids[np.repeat(from_, n) + np.arange(ends[-1])].tobytes()
        cuts = (4 * ends[per_text]).tolist()
        out = [flat[a:b] for a, b in zip(cuts, cuts[1:])]
        for i in np.nonzero(whole)[0].tolist():
            out[i] = self._slow(texts[i].as_py())
        return out

    def _slow(self, text: str) -> bytes:
        if _OTHER_SPACE.search(text) or any(a in text for a in self.added):
            return self._whole(text)
        parts = [e.ids for e in self.tokenizer.encode_batch_fast(
            _RUN_AND_WORD.findall(text), add_special_tokens=False)]
        return array("I", [i for ids in parts for i in ids]).tobytes()


def encoder(path: str, joined: bool, max_cached: int = 500_000) -> ChunkEncoder:
    """One encoder per Python worker and vocabulary."""
    key = (path, joined)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, joined, max_cached)
    return _ENCODERS[key]
