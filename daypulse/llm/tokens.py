"""BPE ids of many texts at once, equal to
``Tokenizer.encode(text, add_special_tokens=False).ids``.

Two kinds of tokenizer files are read: byte-level BPE without a prefix space,
and BPE with word ends that lower-cases and drops white space. Both cut a text
into words whose ids do not depend on their neighbours, and a single space
between two characters that are not white space always begins a word. So a
slice of texts is split at its spaces by Arrow, each distinct piece of the
slice is encoded once, and the texts' ids are gathered from the pieces' ids.
Texts with other white space next to a space, or with a special token's string
in them, are encoded whole.

A worker remembers pieces from slice to slice as Arrow columns (strings, and
their ids), which take a few bytes beside their content; both the memory for
them and the size of a slice are bounded in bytes, whatever the corpus.
"""

from __future__ import annotations

import re
from codecs import charmap_decode
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of remembered pieces and their ids, for each of the two kinds (first in a text, behind a space).
CACHE_BYTES = 32_000_000
#: Texts are taken in slices of about so many bytes.
SLICE_BYTES = 6_000_000
#: Ends of pieces (marks and the like) that are remembered.
MAX_TAILS = 20_000
#: Within a piece: runs of Latin letters, of ASCII digits, of ASCII marks but the apostrophe, and single line feeds before
#: something; each is a word. Other pieces are encoded as they are.
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"
_CHUNKS = re.compile(rf"[{_LETTERS}]+|[0-9]+|[{_MARKS}]+|\n").findall
_CHUNKED = re.compile(rf"(?:[{_LETTERS}0-9{_MARKS}]++(?:\n(?=[{_LETTERS}0-9{_MARKS}]))?+)++").fullmatch
#: Letters of common scripts that have long been letters in every version of Unicode.
_OTHER_LETTERS = "Ā-ɏΑ-ΡΣ-ώЀ-ҁҊ-ԯא-תء-غف-يぁ-ゖァ-ヺ一-龥가-힣"
_IDS = np.dtype("<u4")
# Fixed values of byte-level BPE: a visible Latin-1 byte is its own character, the other bytes are 256, 257, ... in order.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SPACE = "Ġ"
_OTHERS = [b for b in range(256) if b not in _VISIBLE]
_BYTE_CHARS = "".join(chr(256 + _OTHERS.index(b)) if b in _OTHERS else chr(b) for b in range(256))


def _gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs flat[start:start + size] one behind the other, and their ends
    (with a leading 0)."""
    done = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=done[1:])
    where = np.repeat((start - done[:-1]).astype(np.int32), size)
    where += np.arange(done[-1], dtype=np.int32)
    return flat[where], done


class Pieces:
    """Remembered pieces of one kind: strings, and the runs of their ids."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.words, self.flat = pa.array([], pa.string()), np.zeros(0, _IDS)
        self.start, self.used = np.zeros(0, np.int64), np.zeros(0, bool)

    def find(self, words: pa.Array) -> np.ndarray:
        """Place of each word, or -1; the found ones count as used."""
        if not len(self.words):
            return np.full(len(words), -1, np.int64)
        at = np.asarray(pc.fill_null(pc.index_in(words, value_set=self.words), -1)).astype(np.int64)
        self.used[at[at >= 0]] = True
        return at

    def runs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.append(self.start, len(self.flat))
        return ends[at], ends[at + 1] - ends[at]

    def add(self, words: pa.Array, flat: np.ndarray, ends: np.ndarray) -> None:
        """Remember words whose ids are flat, cut at ends. Beyond the bound
        those that were not used since the last time go, then all."""
        if self.words.nbytes + self.flat.nbytes > CACHE_BYTES:
            keep = np.flatnonzero(self.used)
            start, size = self.runs(keep)
            words_kept = self.words.take(pa.array(keep))
            kept, done = _gather(self.flat, start, size)
            self.clear()
            if words_kept.nbytes + kept.nbytes < CACHE_BYTES // 2:
                self.words, self.flat, self.start, self.used = words_kept, kept, done[:-1], np.zeros(len(keep), bool)
        if words.nbytes + flat.nbytes > CACHE_BYTES // 2:
            return
        self.start = np.concatenate([self.start, ends[:-1] + len(self.flat)])
        self.words, self.flat = pa.concat_arrays([self.words, words]), np.concatenate([self.flat, flat])
        self.used = np.concatenate([self.used, np.zeros(len(words), bool)])


class Encoder:
    """One tokenizer file, with its remembered pieces."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model  # merges one word, given as its byte characters
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.by_words = bool(self.model.end_of_word_suffix)  # lower-cases and drops white space
        self.lead = "" if self.by_words else " "
        self.letters = _LETTERS if self.by_words else _LETTERS + _OTHER_LETTERS  # a run of them is one word
        self.word = re.compile(f"[{self.letters}]+").fullmatch
        self.after_space = Pieces()
        self.first = Pieces() if self.lead else self.after_space
        self.tails: dict[str, bytes] = {}

    def _words(self, words: list[str], lead: str = "") -> list[list[int]]:
        """Ids of strings that are one word each, as they stand behind ``lead``."""
        merge = self.model.tokenize
        if self.by_words:
            words = [w.lower() for w in words]
        mark = _SPACE if lead else ""
        return [[t.id for t in merge(mark + w if w.isascii() else mark + charmap_decode(w.encode(), "strict", _BYTE_CHARS)[0])]
                for w in words]

    def _texts(self, texts: list[str], lead: str = "") -> list[list[int]]:
        return [e.ids for e in self.whole.encode_batch_fast([lead + t for t in texts], add_special_tokens=False)]

    def _encode(self, coder, strings: list[str], lead: str = "") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all strings, and where each one's end (with a leading 0)."""
        flat, sizes = [np.zeros(0, _IDS)], [np.zeros(1, np.int64)]
        for at in range(0, len(strings), 2_000):
            ids = coder(strings[at:at + 2_000], lead)
            sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.fromiter(chain.from_iterable(ids), _IDS, int(sizes[-1].sum())))
        return np.concatenate(flat), np.cumsum(np.concatenate(sizes))

    def _mixed(self, strings: list[str], lead: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and ends of each string. One of several words is cut into them
        first, so that a word is merged once whatever mark follows it."""
        chunks = [_CHUNKS(s) if _CHUNKED(s) else [s] for s in strings]
        heads = dict.fromkeys([c[0] for c in chunks])
        if len(self.tails) > MAX_TAILS:
            self.tails.clear()
        tails = {x for c in chunks if len(c) > 1 for x in c[1:]}.difference(self.tails)
        for table, before, wanted in ((heads, lead, heads), (self.tails, "", tails)):
            words = [w for w in wanted if self.word(w)]
            others = [w for w in wanted if not self.word(w)]
            for coder, some in ((self._words, words), (self._texts, others)):
                flat, ends = self._encode(coder, some, before)
                data, cuts = flat.tobytes(), (ends * _IDS.itemsize).tolist()
                table.update(zip(some, [data[i:j] for i, j in zip(cuts, cuts[1:])]))
        tail = self.tails.__getitem__
        out = [heads[c[0]] if len(c) == 1 else heads[c[0]] + tail(c[1]) if len(c) == 2 else
               b"".join([heads[c[0]], *map(tail, c[1:])]) for c in chunks]
        sizes = np.fromiter(map(len, out), np.int64, len(out)) // _IDS.itemsize
        return np.frombuffer(b"".join(out), _IDS), np.concatenate([[0], np.cumsum(sizes)])

    def _coded(self, words: pa.Array, known: Pieces, lead: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat, start, size): the runs of ids of distinct words."""
        at = known.find(words)
        old, new = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        start, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        start[old], size[old] = known.runs(at[old])
        flat = known.flat
        if len(new):
            fresh = words.take(pa.array(new))
            single = pc.match_substring_regex(fresh, f"^[{self.letters}]+$")
            many = pc.invert(single)
            new = np.concatenate([new[np.asarray(m).astype(bool)] for m in (single, many)])
            fresh = pa.concat_arrays([fresh.filter(single), fresh.filter(many)])
            n = int(pc.sum(single).as_py())
            one, stops = self._encode(self._words, fresh[:n].to_pylist(), lead)
            more, ends = self._mixed(fresh[n:].to_pylist(), lead)
            more, ends = np.concatenate([one, more]), np.concatenate([stops, stops[-1] + ends[1:]])
            start[new], size[new] = len(flat) + ends[:-1], np.diff(ends)
            flat = np.concatenate([flat, more])
            known.add(fresh, more, ends)
        return flat, start, size

    def _odd(self, words: pa.Array) -> np.ndarray:
        """Pieces that are empty, have white space at an end or hold a special
        token: they spoil their text's cuts."""
        odd = pc.or_(pc.equal(pc.binary_length(words), 0), pc.not_equal(pc.utf8_trim_whitespace(words), words))
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(words, s))
        return np.asarray(odd.cast(pa.uint8())).astype(bool)

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.split_pattern(texts, " ")
        ends = np.asarray(split.offsets).astype(np.int64)
        ends -= ends[0]
        coded = split.flatten().dictionary_encode()
        words, codes = coded.dictionary, np.asarray(coded.indices)
        del split, coded
        odd, first = self._odd(words), ends[:-1]
        spoilt = np.add.reduceat(odd[codes], first, dtype=np.int64) > 0
        used = np.repeat(~spoilt, np.diff(ends))
        used[first] = False  # a text's first piece has no space before it
        inner = np.flatnonzero(np.bincount(codes[used], minlength=len(words)))
        clean, whole = np.flatnonzero(~spoilt), np.flatnonzero(spoilt)
        # Three tables of runs behind each other: pieces after a space, first pieces, whole texts.
        firsts, which = np.unique(codes[first[clean]], return_inverse=True)
        a = self._coded(words.take(pa.array(inner)), self.after_space, self.lead)
        b = self._coded(words.take(pa.array(firsts)), self.first, "")
        c, stops = self._encode(self._texts, texts.take(pa.array(whole)).to_pylist())
        flat = np.concatenate([a[0], b[0], c])
        start = np.concatenate([a[1], b[1][which] + len(a[0]), stops[:-1] + len(a[0]) + len(b[0])])
        size = np.concatenate([a[2], b[2][which], np.diff(stops)])
        at = np.zeros(len(words) + len(texts), np.int32)  # run of a piece; behind the words, the texts' first pieces
        at[np.concatenate([inner, len(words) + clean, len(words) + whole])] = np.arange(len(size), dtype=np.int32)
        codes = codes.copy()
        codes[first] = len(words) + np.arange(len(texts), dtype=np.int32)
        used[first] = True
        order = at[codes[used]]
        found, done = _gather(flat, start[order], size[order])
        return found, done[np.concatenate([[0], np.cumsum(np.add.reduceat(used, first, dtype=np.int64))])]

    def batches(self, texts: pa.Array):
        """Yields (from row, ids, offsets) for slices of the texts; row i of a
        slice has ids[offsets[i]:offsets[i + 1]]. Null is the empty text."""
        texts = pc.fill_null(texts, "")
        if not pa.types.is_string(texts.type):
            texts = texts.cast(pa.string())
        size = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64))])
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(size, size[at] + SLICE_BYTES, side="right")) - 1)
            yield (at, *self._slice(texts.slice(at, to - at)))
            pa.default_memory_pool().release_unused()
            at = to


@cache
def encoder(path: str) -> Encoder:
    """The worker's encoder for a file, kept from task to task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def default_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    """Path of one of the public tokenizer files, the 50k byte-level BPE if
    none is named."""
    import public_tokenizers

    return public_tokenizers.path(name)


def document_crc(ids: np.ndarray, cuts: np.ndarray) -> list[int]:
    """crc32 of the runs of ids between consecutive cuts, as little-endian
    unsigned 32-bit integers."""
    import zlib

    view = memoryview(np.ascontiguousarray(ids, _IDS)).cast("B")
    at = (np.asarray(cuts) * _IDS.itemsize).tolist()
    return [zlib.crc32(view[i:j]) for i, j in zip(at, at[1:])]


def with_end(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a slice with the end id behind each text, and the new ends."""
    n = len(ends) - 1
    out = np.full(len(ids) + n, end_id, _IDS)
    keep = np.ones(len(out), bool)
    stops = ends + np.arange(n + 1)
    keep[stops[1:] - 1] = False
    out[keep] = ids
    return out, stops
