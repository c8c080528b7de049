"""Tokenizing and splitting texts by their distinct words, in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that an encoder keeps for its next texts: those asked for in bulk, and those within other pieces.
SLICE_BYTES, CACHE_WORDS, CACHE_PARTS = 6 << 20, 400_000, 50_000
#: Two characters in a row that some reading of Unicode takes as white space (RE2 syntax).
GAP = r"[\s\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]{2}"
SAFE_SPACE = re.compile(r"(?<=[^\s᠎​-‏﻿]) (?=[^\s᠎​-‏﻿])")
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"  # without the capital I with a dot, whose lower case is two characters
#: Letters with at most one comma or full stop, then perhaps a line break and the same again.
PLAIN = re.compile(rf"([{LETTERS}]+)([.,]?)(?:\n([{LETTERS}]+)([.,]?))?")
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
#: Lines of letters, each perhaps with marks after it: letters are one token of the pre-tokenizers, marks the next (RE2 syntax).
LINE = rf"[{LETTERS}]+[{re.escape(MARKS)}]*"
SIMPLE = rf"^{LINE}(\n{LINE})*$"


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each piece hold about ``most`` bytes (one row at least).

    What Arrow keeps of a piece's memory is given back after it: workers wait for their next task with all they hold.
    """
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most)))
            yield batch.slice(at, stop - at)
            pa.default_memory_pool().release_unused()
            at = stop


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of many runs, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    at = np.repeat(starts - (ends - lengths), lengths)
    at += np.arange(total, dtype=np.int64)
    return at


def offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths, dtype=np.int64)])


def pieces(texts: pa.Array, added: Sequence[str] = ()) -> tuple[np.ndarray, np.ndarray, pa.Array, list[str]]:
    """Texts cut before every space that stands alone: (piece numbers, pieces of each text, names, others).

    No token of the tokenizers used here reaches over such a cut: a space can only begin a token. Pieces
    are numbered by ``names``, which lack the space before them, and on from there by ``others``, which
    are complete: those that begin a text and those of texts with odd white space. A text that holds one of
    the strings ``added`` is one piece, and complete.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    wild = pc.match_substring_regex(texts, GAP).to_numpy(zero_copy_only=False)
    whole = np.zeros(len(texts), bool)
    for token in added:
        whole |= pc.match_substring(texts, token, ignore_case=True).to_numpy(zero_copy_only=False)
    wild = np.flatnonzero(wild | whole)
    split = pc.split_pattern(texts, " ")
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.dictionary_encode(pc.list_flatten(split))
    codes, names = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), flat.dictionary
    firsts = offsets(counts)[:-1]
    heads, back = np.unique(codes[firsts], return_inverse=True)
    codes[firsts] = len(names) + back
    others = pc.take(names, pa.array(heads)).to_pylist()
    if len(wild):
        known: dict[str, int] = {}
        parts, at, done, new = [], offsets(counts), 0, counts.copy()
        for i in wild.tolist():
            text = texts[i].as_py()
            words = [text] if whole[i] else [w if k == 0 else " " + w for k, w in enumerate(SAFE_SPACE.split(text))]
            numbers = [known.setdefault(w, len(names) + len(others) + len(known)) for w in words]
            parts += [codes[at[done] : at[i]], np.array(numbers, dtype=np.int64)]
            done, new[i] = i + 1, len(words)
        codes, counts = np.concatenate([*parts, codes[at[done] :]]), new
        others += list(known)
    return codes, counts, names, others


class Encoder:
    """Token ids of whole texts by the tokenizers library, asked once for each distinct piece.

    ``spaces``: whether the vocabulary keeps spaces (byte-level) or drops them. Texts that hold the string
    of an added token, such as a special one, are given to the library whole.
    """

    def __init__(self, definition: str, spaces: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.spaces = self.tokenizer.model, spaces
        self.model._resize_cache(0)  # every run of letters is asked for once
        self.words: dict[str, list[int]] = {}
        self.known = pa.array([], pa.large_string())  # the words whose ids are kept one after the other
        self.kept, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int32)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.bytes = {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}  # the byte-level alphabet

    def _asked(self, word: str) -> list[int]:
        """Ids of a run of letters, or a mark, that is one token of the pre-tokenizer."""
        if not self.spaces:
            return [t.id for t in self.model.tokenize(word.lower())] if word.isascii() else self.tokenizer.encode(word, add_special_tokens=False).ids
        if word.isascii() and word != "\n":  # only the space has another character in the byte-level alphabet
            return [t.id for t in self.model.tokenize(word.replace(" ", "Ġ"))]
        return [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.bytes))]

    def _word(self, word: str) -> list[int]:
        ids = self.words.get(word)
        if ids is None:
            ids = self._asked(word)
            if len(self.words) < CACHE_PARTS:
                self.words[word] = ids
        return ids

    def _many(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, offsets in them, lengths) of distinct words; the known ones by a gather."""
        numbers = pc.index_in(words, value_set=self.known)
        new = words.filter(numbers.is_null())
        ids, lengths = flattened([self._asked(w) for w in new.to_pylist()])
        numbers = pc.fill_null(numbers, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        first, room = len(self.known), max(CACHE_WORDS - len(self.known), 0)
        kept, all_lengths = np.concatenate([self.kept, ids]), np.concatenate([self.lengths, lengths.astype(np.int32)])
        numbers[numbers < 0] = first + np.arange(len(new))
        if room and len(new):
            self.known = pa.concat_arrays([self.known, new.slice(0, room)])
            self.lengths = all_lengths[: first + room]
            self.kept = kept[: int(self.lengths.sum())].copy()
        return kept, offsets(all_lengths)[:-1][numbers], all_lengths[numbers].astype(np.int64)

    def _piece(self, piece: str) -> list[int]:
        body = piece[1:] if piece.startswith(" ") else piece
        plain = PLAIN.fullmatch(body)
        if plain is None:
            return self.tokenizer.encode(piece, add_special_tokens=False).ids if piece else []
        first, mark, second, last = plain.groups()
        ids = self._word(" " + first if self.spaces and body is not piece else first)
        if mark:
            ids = ids + self._word(mark)
        if second:
            ids = ids + (self._word("\n") if self.spaces else []) + self._word(second)
            if last:
                ids = ids + self._word(last)
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(piece numbers, pieces of each text, ids of all distinct pieces, their offsets)."""
        codes, counts, names, others = pieces(texts, self.added)
        plain = pc.match_substring_regex(names, SIMPLE).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(names.filter(pa.array(plain)), "\n")
        lines, per = pc.list_flatten(split), pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        begins = np.zeros(len(lines), bool)
        begins[offsets(per)[:-1]] = True
        stems = pc.ascii_rtrim(lines, MARKS)
        marked = np.flatnonzero((pc.binary_length(lines).to_numpy(zero_copy_only=False) > pc.binary_length(stems).to_numpy(zero_copy_only=False)))
        marks = pc.dictionary_encode(pc.replace_substring_regex(lines.take(pa.array(marked)), rf"^[{LETTERS}]+", ""))
        mark_ids, mark_lengths = flattened([self._word(m) for m in marks.dictionary.to_pylist()])
        mark_of = marks.indices.to_numpy(zero_copy_only=False)
        # A name has a space before its first line, which is part of the token in vocabularies that keep spaces.
        lead = begins if self.spaces else np.zeros(len(lines), bool)
        after_space, plainly = (pc.dictionary_encode(stems.filter(pa.array(some))) for some in (lead, ~lead))
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), after_space.dictionary, pa.scalar("", pa.large_string()))
        kept, stem_at, stem_lengths = self._many(pa.concat_arrays([spaced, plainly.dictionary]))
        which = np.empty(len(lines), np.int64)
        which[lead] = after_space.indices.to_numpy(zero_copy_only=False)
        which[~lead] = len(spaced) + plainly.indices.to_numpy(zero_copy_only=False)
        stem_at, stem_lengths = stem_at[which], stem_lengths[which]
        breaks = (~begins).astype(np.int64) if self.spaces else np.zeros(len(lines), np.int64)
        line_lengths = breaks + stem_lengths
        line_lengths[marked] += mark_lengths[mark_of]
        line_at = offsets(line_lengths)
        rest, rest_lengths = flattened([self._piece(" " + p) for p in names.filter(pa.array(~plain)).to_pylist()] + [self._piece(p) for p in others])
        # All names in their order, then the others.
        lengths = np.empty(len(names) + len(others), np.int64)
        is_plain = np.concatenate([plain, np.zeros(len(others), bool)])
        firsts = offsets(per)
        lengths[is_plain] = line_at[firsts[1:]] - line_at[firsts[:-1]]
        lengths[~is_plain] = rest_lengths
        at = offsets(lengths)
        flat = np.empty(int(at[-1]), np.uint32)
        start = line_at[:-1] + np.repeat(at[:-1][is_plain] - line_at[firsts[:-1]], per)
        broken = np.flatnonzero(breaks)
        if len(broken):
            flat[start[broken]] = self._word("\n")[0]
        start += breaks
        flat[ragged(start, stem_lengths)] = kept[ragged(stem_at, stem_lengths)]
        if len(marked):
            flat[ragged((start + stem_lengths)[marked], mark_lengths[mark_of])] = mark_ids[ragged(offsets(mark_lengths)[:-1][mark_of], mark_lengths[mark_of])]
        flat[ragged(at[:-1][~is_plain], rest_lengths)] = rest
        return codes, counts, flat, at

    def ids(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by ``end``; offsets of the texts)."""
        codes, counts, flat, at = self.encode(texts)
        return joined(codes, counts, flat, at, end)


_encoders: dict[tuple[int, bool], Encoder] = {}


def encoder(definition: str, spaces: bool) -> Encoder:
    """The worker's encoder of a vocabulary: the words it has seen stay known from task to task."""
    key = (hash(definition), spaces)
    if key not in _encoders:
        _encoders[key] = Encoder(definition, spaces)
    return _encoders[key]


def flattened(runs: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs))
    return np.fromiter(chain.from_iterable(runs), dtype=np.uint32, count=int(lengths.sum())), lengths


def joined(codes: np.ndarray, counts: np.ndarray, flat: np.ndarray, at: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.diff(at)[codes]
    ends = offsets(lengths)[offsets(counts)[1:]]  # of the texts, without their end ids
    out = np.empty(int(lengths.sum()) + len(counts), flat.dtype)
    after = ends + np.arange(1, len(counts) + 1)
    keep = np.ones(len(out), bool)
    keep[after - 1] = False
    out[keep] = flat[ragged(at[:-1][codes], lengths)]
    out[after - 1] = end
    return out, np.concatenate([np.zeros(1, np.int64), after])


def definition(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
