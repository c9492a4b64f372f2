"""Token ids of whole texts from the tokenizers library, with each distinct word encoded once.

Byte-level BPE splits a text into words before it merges anything; a blank between two visible characters always
begins a word, and a line feed between two is one. So a text is cut before its blanks and line feeds, the distinct
pieces of a batch are looked up in a bounded memory, the library encodes those not known yet, and the ids of the
pieces are put together in order. Marks that end a piece are encoded apart. Texts with two white-space characters in
a row, where that rule does not hold, and those that begin with a rare one are given to the library whole.

The memory is a string array with flat ids, looked up by Arrow for a batch at a time: no Python object is kept for a piece.
"""

from __future__ import annotations

import codecs
import ctypes
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

BYTE_BPE = "byte_bpe_50k.json"
# Pieces remembered per Python worker, about 50 bytes each.
REMEMBERED = 500_000
# Texts are encoded in batches of about this many bytes, and texts given to the library whole in smaller ones.
BATCH_BYTES = 8 << 20
_WHOLE_BYTES = 1 << 20
_BLANK, _LINE = "Ġ", "Ċ"  # a blank and a line feed, as byte-level vocabularies spell them
_MARKS = ".,!?;:|$%&#*"  # after a letter, a run of these at the end of a piece is a word of its own
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"  # letters for every version of Unicode
_OTHER_SPACE = r"\t\x{B}-\r\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_SPACE = rf"[ \n{_OTHER_SPACE}]"


# How byte-level vocabularies spell bytes from 127 on: those that are no visible character of Latin-1, after 33 lower ones, from U+0121 on.
_MOVED = [*range(127, 161), 173]
_SPELLINGS = "".join(chr(0x121 + _MOVED.index(b) if b in _MOVED else b) for b in range(256))


def tokenizer_path(name: str) -> str:
    """The place of a vocabulary file: an absolute path as it is, or that of a public one by name."""
    return name if os.path.isabs(name) else public_tokenizers.path(name)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``values[start : start + length]``, one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return values[:0]
    at = np.repeat(starts - (ends - lengths), lengths)
    at += np.arange(ends[-1])
    return values[at]


def _behind(texts: pa.Array, sizes: np.ndarray) -> pa.Array:
    """What follows the first ``size`` bytes of each of some large strings."""
    if not len(texts):
        return texts
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    lengths = np.diff(edges) - sizes
    data = gather(np.frombuffer(texts.buffers()[2], np.uint8), edges[:-1] + sizes, lengths)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(data))


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return unused memory to the system. An executor keeps more Python workers than it has cores, each with what its
    largest task took: Arrow's pool and the C library hold on to tens of MB that nothing uses."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def slices(texts: pa.Array, limit: int = BATCH_BYTES) -> Iterator[pa.Array]:
    """A string array in parts of about ``limit`` bytes, of one text at least. Memory of the part before is given back:
    a worker lives on between tasks, and Arrow's pool would keep what the largest part took."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        upto = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + limit, "right"))
        upto = max(at + 1, upto)
        yield texts.slice(at, upto - at)
        at = upto
        if at < len(texts):
            pa.default_memory_pool().release_unused()
    # once a batch, since memory taken anew costs time
    give_back()


def _parts(places: np.ndarray, size: int = 2000) -> Iterator[np.ndarray]:
    return (places[k : k + size] for k in range(0, len(places), size))


class PieceEncoder:
    """Encodes string arrays to flat ids and the number of ids of each text."""

    def __init__(self, vocabulary: str = BYTE_BPE):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(tokenizer_path(vocabulary))
        self.model = self.tokenizer.model
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        words = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.opens = np.array([w.startswith(_BLANK) for w in words])
        self.known = pa.array([], pa.large_string())
        self.ids, self.lengths, self.seen = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, counts)`` of a batch of texts; null is the empty text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = pc.match_substring_regex(texts, f"{_SPACE}{_SPACE}|^[{_OTHER_SPACE}]").to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._by_pieces(texts)
        plain = np.flatnonzero(~whole)
        ids, counts = self._by_pieces(texts.take(pa.array(plain)))
        odd_ids = []
        for part in slices(texts.take(pa.array(np.flatnonzero(whole))), _WHOLE_BYTES):
            odd_ids += self._each(part.to_pylist())
        every = np.concatenate([ids, *odd_ids])
        sizes, starts = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        sizes[plain], sizes[whole] = counts, [len(x) for x in odd_ids]
        starts[plain] = np.cumsum(counts) - counts
        starts[whole] = len(ids) + np.cumsum(sizes[whole]) - sizes[whole]
        return gather(every, starts, sizes), sizes

    def _each(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        # a line feed stands before each text, so that its first piece has no blank before it; that id is left out again
        feed, none = (pa.scalar(x, pa.large_string()) for x in ("\n", ""))
        split = pc.split_pattern(pc.binary_join_element_wise(feed, pc.replace_substring(texts, "\n", " \n"), none), " ")
        offsets = split.offsets.to_numpy()
        offsets = offsets - offsets[0]
        distinct = split.flatten().dictionary_encode()
        ids, lengths = self._pieces(distinct.dictionary)
        codes = distinct.indices.to_numpy()
        sizes, starts = lengths[codes], (np.cumsum(lengths) - lengths)[codes]
        starts[offsets[:-1]] += 1
        sizes[offsets[:-1]] -= 1
        ends = np.concatenate([[0], np.cumsum(sizes)])[offsets]
        # executors hold several workers, and Arrow's pool would keep what the largest batch took
        del split, distinct, codes
        pa.default_memory_pool().release_unused()
        return gather(ids, starts, sizes), np.diff(ends)

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, lengths)`` of distinct pieces. Each begins with a line feed or has a blank before it."""
        bodies = pc.utf8_rtrim(pieces, _MARKS)
        marked = pc.and_(pc.not_equal(bodies, pieces), pc.match_substring_regex(bodies, f"[{_LETTERS}]$"))
        coded = pc.if_else(marked, bodies, pieces).dictionary_encode()
        ids, starts, lengths = self._words(coded.dictionary)
        own = coded.indices.to_numpy()
        has = marked.to_numpy(zero_copy_only=False)
        if not has.any():
            return gather(ids, starts[own], lengths[own]), lengths[own]
        tails = _behind(pieces.filter(marked), pc.binary_length(bodies.filter(marked)).to_numpy()).dictionary_encode()
        each = self._each(tails.dictionary.to_pylist())
        tail_sizes = np.array([len(x) for x in each], np.int64)
        tail_starts = len(ids) + np.cumsum(tail_sizes) - tail_sizes
        both, sizes = np.zeros((len(own), 2), np.int64), np.zeros((len(own), 2), np.int64)
        both[:, 0], sizes[:, 0] = starts[own], lengths[own]
        tail = tails.indices.to_numpy()
        both[has, 1], sizes[has, 1] = tail_starts[tail], tail_sizes[tail]
        return gather(np.concatenate([ids, *each]), both.ravel(), sizes.ravel()), sizes.sum(axis=1)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, starts, lengths)`` of distinct pieces without end marks, which are then remembered."""
        # the words of a batch are fewer than those remembered, so the table is made of them
        found = pc.index_in(self.known, value_set=words)
        there = found.is_valid().to_numpy(zero_copy_only=False)
        places = np.full(len(words), -1, np.int64)
        places[found.drop_null().to_numpy()] = np.flatnonzero(there)
        new = np.flatnonzero(places < 0)
        places[new] = len(self.known) + np.arange(len(new))
        self.seen += there & (self.seen < 255)
        missing = words.take(pa.array(new))
        ids, lengths = self._encode_new(missing)
        self.known = pa.concat_arrays([self.known, missing])
        self.ids, self.lengths = np.concatenate([self.ids, ids]), np.concatenate([self.lengths, lengths])
        self.seen = np.concatenate([self.seen, np.ones(len(new), np.uint8)])
        every, starts, lengths = self.ids, (np.cumsum(self.lengths) - self.lengths)[places], self.lengths[places]
        if len(self.known) > REMEMBERED:
            self._tidy()
        return every, starts, lengths

    def _encode_new(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each word."""
        plain = pc.match_substring_regex(words, f"^\n?[{_LETTERS}]+$").to_numpy(zero_copy_only=False)
        first = pc.starts_with(words, "\n").to_numpy(zero_copy_only=False)
        places, sizes, ids = [], [], []

        def add(at: np.ndarray, own: list[list[int]] | list[np.ndarray]) -> None:
            places.append(at), sizes.append(np.fromiter(map(len, own), np.int64, len(own)))
            ids.append(np.fromiter(chain.from_iterable(own), "<u4", int(sizes[-1].sum())))

        tokenize, feed = self.model.tokenize, [self.tokenizer.token_to_id(_LINE)]
        # letters only: one word of the library's, spelled in one character per byte
        for line in (False, True):
            for at in _parts(np.flatnonzero(plain & (first == line))):
                text = ("" if line else "\n").join(words.take(pa.array(at)).to_pylist())[line:]
                spelled = codecs.charmap_decode(text.encode(), "strict", _SPELLINGS)[0].split("\n")
                if line:
                    add(at, [feed + [t.id for t in tokenize(w)] for w in spelled])
                else:
                    add(at, [[t.id for t in tokenize(_BLANK + w)] for w in spelled])
        alone = [np.flatnonzero(~plain & (first | (pc.binary_length(words).to_numpy() == 0)))]
        for at in _parts(np.flatnonzero(~plain & ~np.isin(np.arange(len(words)), alone[0]))):
            # one text of many pieces: each begins at the only id that opens with a blank
            joined = self._each([" " + " ".join(words.take(pa.array(at)).to_pylist())])[0]
            begins = np.flatnonzero(self.opens[joined])
            if len(begins) == len(at):
                places.append(at), sizes.append(np.diff(np.append(begins, len(joined)))), ids.append(joined)
            else:  # a piece with a blank of its own joins its neighbour
                alone.append(at)
        for at in _parts(np.concatenate(alone)):
            texts = zip(words.take(pa.array(at)).to_pylist(), first[at].tolist())
            add(at, self._each([t if line else " " + t for t, line in texts]))
        if not places:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        order, lengths = np.argsort(np.concatenate(places)), np.concatenate(sizes)
        starts = np.cumsum(lengths) - lengths
        return gather(np.concatenate(ids), starts[order], lengths[order]), lengths[order]

    def _tidy(self) -> None:
        """Make room: pieces met in the fewest batches are forgotten until half of the memory is free."""
        least = 2
        while least < 256 and np.count_nonzero(self.seen >= least) > REMEMBERED // 2:
            least += 1
        kept = np.flatnonzero(self.seen >= least)
        self.ids = gather(self.ids, (np.cumsum(self.lengths) - self.lengths)[kept], self.lengths[kept])
        self.known, self.lengths = self.known.take(pa.array(kept)), self.lengths[kept]
        # half of what it was, so that pieces of long ago make room in turn
        self.seen = (self.seen[kept] + 1) // 2


_encoders: dict[str, PieceEncoder] = {}


def encoder(vocabulary: str = BYTE_BPE) -> PieceEncoder:
    """The encoder of this Python worker, kept between tasks."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = PieceEncoder(vocabulary)
    return _encoders[vocabulary]
