"""Whole-text tokenisation with the tokenizers library, cached per chunk.

Both vocabularies used here split a text into pre-tokens before any merge is
applied, and no pre-token crosses the boundary in front of a lone space or
newline, nor the boundary between a letter or digit and the punctuation run
behind it.  Encoding such chunks one by one and joining the ids therefore
gives exactly the ids of the whole text (``tests/llm/test_tokens.py`` holds
it against ``Tokenizer.encode``).  Natural text repeats its words, so a
bounded per-worker cache of chunk ids saves most of the encoder's work.
Texts with runs of white space, or with the string of an added token (which
the tokenizer turns into its special id), take the plain whole-text call.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_TAIL = r"^(?s)(?P<core>.*[\pL\pN])(?P<tail>[!-/:-@\[-^`{-~]+)$"

#: Bytes of text handled at once, and chunks after which a worker's cache starts anew.
SLICE_BYTES = 4_000_000
CACHE_CHUNKS = 1_000_000


def _strings(column: pa.StringArray) -> list[str | None]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself where printable."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


class ChunkEncoder:
    """Ids of texts for one tokenizer file.

    ``spaced`` is true for byte-level vocabularies, where a word and the space
    before it form one pre-token; false where white space is only a separator.
    """

    def __init__(self, path: str, spaced: bool, cache_chunks: int = CACHE_CHUNKS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        added = sorted((t.content for t in self._tok.get_added_tokens_decoder().values()), key=len, reverse=True)
        self._added = "|".join(re.escape(t) for t in added)  # a text that holds one takes the whole-text call
        self._model = self._tok.model
        self._bytes = _byte_letters()
        self._spaced = spaced
        self._cap = cache_chunks
        self._reset()

    def _reset(self) -> None:
        self._index: dict = {}  # chunk -> number; a punctuation tail is kept as (tail,)
        self._start = np.zeros(1024, np.int64)
        self._len = np.zeros(1024, np.int64)
        self._odd = np.zeros(1024, bool)
        self._pool = np.zeros(4096, np.int32)
        self._known = self._used = 0

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, chunks: list, ids: np.ndarray, lens: np.ndarray) -> None:
        k, n, u = self._known, len(chunks), self._used
        while k + n > len(self._len):
            self._start, self._len, self._odd = (np.resize(x, 2 * len(x)) for x in (self._start, self._len, self._odd))
        while u + len(ids) > len(self._pool):
            self._pool = np.resize(self._pool, 2 * len(self._pool))
        self._pool[u : u + len(ids)] = ids
        self._len[k : k + n] = lens
        self._start[k : k + n] = u + np.cumsum(lens) - lens
        self._odd[k : k + n] = False
        self._index.update(zip(chunks, range(k, k + n), strict=True))
        self._known, self._used = k + n, u + len(ids)

    def _add_texts(self, chunks: list, texts: list[str]) -> None:
        self._add_ids(chunks, self._encode(texts))

    def _add_words(self, words: list[str]) -> None:
        """Add chunks of Latin letters: one pre-token each, so the merges apply to them directly."""
        model, letters = self._model.tokenize, self._bytes
        if self._spaced:
            plain = [" " + w for w in words]
        else:
            plain = [w.lower() for w in words]
        self._add_ids(words, [[t.id for t in model(w.encode().decode("latin-1").translate(letters))] for w in plain])

    def _add_ids(self, chunks: list, ids: list[list[int]]) -> None:
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        self._add(chunks, np.fromiter(chain.from_iterable(ids), np.int32, int(lens.sum())), lens)

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the chunks numbered ``at``, joined, and each one's length."""
        lens = self._len[at]
        ends = np.cumsum(lens)
        take = np.repeat(self._start[at] - ends + lens, lens)
        take += np.arange(len(take))
        return self._pool[take], lens

    def _learn(self, missing: list[str]) -> None:
        """Add chunks: words are encoded, and a word with a punctuation tail is joined from both."""
        if self._spaced:
            odd = [w for w in missing if w == "\n" or len(w.split()) != 1 or w[-1].isspace() or w.lstrip("\n")[:1].isspace()]
            if odd:
                self._add(odd, np.zeros(0, np.int32), np.zeros(len(odd), np.int64))
                self._odd[self._known - len(odd) : self._known] = True
                missing = [w for w in missing if w not in self._index]
        parts = pc.extract_regex(pa.array(missing, pa.string()), _TAIL)
        cores = _strings(pc.fill_null(pc.struct_field(parts, "core"), pa.array(missing, pa.string())))
        tails = _strings(pc.struct_field(parts, "tail"))
        known = self._index
        words, fresh = [], []
        for c in set(cores):
            if c not in known:
                (words if c.isalpha() and (c.isascii() or max(c) < "\u0130") else fresh).append(c)
        self._add_words(words)
        space = " " if self._spaced else ""
        self._add_texts(fresh, [c if c[:1] == "\n" else space + c for c in fresh])
        marks = [t for t in set(tails) if t is not None and (t,) not in known]
        self._add_texts([(t,) for t in marks], marks)
        joined = [(m, known[c], known[(t,)]) for m, c, t in zip(missing, cores, tails, strict=True) if t is not None and m not in known]
        ids, lens = self._gather(np.array([k for j in joined for k in j[1:]], np.int64))
        self._add([j[0] for j in joined], ids, lens[0::2] + lens[1::2])

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one int32 array, and the number of ids of each text (no text may be null)."""
        held = pc.match_substring_regex(texts, self._added) if self._added else None
        if held is None or not pc.any(held).as_py():
            return self._encode_chunks(texts)
        ids, counts = self._encode_chunks(pc.if_else(held, "", texts))
        at = np.flatnonzero(held.to_numpy(zero_copy_only=False))
        own = [np.array(x, np.int32) for x in self._encode([texts[int(i)].as_py() for i in at])]
        starts = (np.cumsum(counts) - counts)[at]
        ids = np.insert(ids, np.repeat(starts, [len(x) for x in own]), np.concatenate(own))
        counts = counts.copy()
        counts[at] = [len(x) for x in own]
        return ids, counts

    def _encode_chunks(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` for texts without an added token."""
        if self._known > self._cap:
            self._reset()
        if not self._known:
            self._add([""], np.zeros(0, np.int32), np.zeros(1, np.int64))
            self._odd[0] = self._spaced
        spread = pc.replace_substring(texts, "\n", " \n" if self._spaced else " ")
        chunks = pc.split_pattern(spread, " ")
        edge = chunks.offsets.to_numpy()
        edge = edge - edge[0]
        coded = chunks.flatten().dictionary_encode()
        words = _strings(coded.dictionary)
        at = np.fromiter(map(self._index.get, words, repeat(-1)), np.int64, len(words))
        if (gone := np.flatnonzero(at < 0)).size:
            self._learn([words[i] for i in gone])
            at[gone] = [self._index[words[i]] for i in gone]
        which = coded.indices.to_numpy()
        at = at[which]
        apart: dict[int, str] = {}  # encoded as written: whole texts, and first chunks (no space before)
        if self._spaced:
            # white space beside white space or at an end, or another kind of it: in one piece
            odd = self._odd[at]
            for i in range(len(texts)):
                a, b = edge[i], edge[i + 1]
                if odd[a:b].any():
                    apart[i] = texts[i].as_py()
                    at[a:b] = 0
                else:
                    apart[i] = words[which[a]]
                    at[a] = 0
        ids, lens = self._gather(at)
        before = np.concatenate([[0], np.cumsum(lens)])[edge]
        counts = np.diff(before)
        if apart:
            own = {i: np.array(x, np.int32) for i, x in zip(apart, self._encode(list(apart.values())), strict=True)}
            ids = np.concatenate([x for i in range(len(texts)) for x in (own[i], ids[before[i] : before[i + 1]])] or [ids])
            counts = counts + [len(own[i]) for i in range(len(texts))]
        return ids, counts


@lru_cache(maxsize=2)
def encoder(path: str, spaced: bool) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file (one per Python worker process)."""
    return ChunkEncoder(path, spaced)


def slices(texts: pa.StringArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.StringArray]]:
    """(first position, texts) pieces of about ``limit`` bytes; a longer text stands alone."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield at, texts.slice(at, to - at)
        at = to
