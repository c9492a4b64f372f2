"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word exactly one token can be its last: the token must be a suffix of the
prefix, and the last token of what is left must be compatible with it, which means that merging would
not have joined them otherwise across their seam. An automaton over all tokens gives the
suffixes of every prefix in one pass, the table of last tokens is filled from left to right, and
following it back from the end gives the ids. No merge is ever carried out on a text.

The vocabulary is a ``tokenizers`` file with byte-level BPE and an end-of-word mark, as in
``word_bpe_49k.json``; words repeat, so their ids are remembered per Python worker up to a bound.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from veil.llm.common import column, text_of
from veil.llm.tokens import gather, slices, tokenizer_path

WORD_BPE = "word_bpe_49k.json"
REMEMBERED = 300_000
_BATCH_BYTES = 2 << 20
_END = "</w>"
_SPACE = r"\t-\r \x85\xa0  -     　"
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
# Texts of other characters are normalised and split by the library itself.
_ODD = regex.compile(r"[^\x00-˿‐-‧‰-⁞]")


def byte_letters() -> list[str]:
    """How byte-level vocabularies spell each byte: visible ones as they are, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    return [others.get(b) or chr(b) for b in range(256)]


class PrefixBpe:
    """Encodes and decodes with one vocabulary."""

    def __init__(self, vocabulary: str = WORD_BPE):
        from tokenizers import Tokenizer

        path = tokenizer_path(vocabulary)
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        self.library = Tokenizer.from_file(path)
        vocab, merges = described["model"]["vocab"], described["model"]["merges"]
        names = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in described["added_tokens"]}
        self.names = pa.array([names.get(i, "") for i in range(max(names) + 1)], pa.large_string())
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self._split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.letters = {c: b for b, c in enumerate(byte_letters())}
        # a word is spelled in one character per byte; the last one is moved up by 256
        spelled, self.made = {}, {}
        for letter, byte in self.letters.items():
            for text, code in ((letter, byte), (letter + _END, 256 + byte)):
                if text in vocab:
                    spelled[vocab[text]] = chr(code)
        self.joins: dict[tuple[int, int], int] = {}  # pair of tokens: rank of their merge
        for rank, (left, right) in enumerate(merges):
            a, b, token = vocab[left], vocab[right], vocab[left + right]
            self.joins.setdefault((a, b), rank)
            if token not in self.made:
                self.made[token] = (rank, a, b)
                spelled[token] = spelled[a] + spelled[b]
        self.automaton = ahocorasick.Automaton()
        for token, text in spelled.items():
            if self._stands(token):
                self.automaton.add_word(text, (token, len(text)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self._forget()

    def _stands(self, token: int) -> bool:
        """Whether a token survives on its own text: its two parts must be compatible without their own merge."""
        if token not in self.made:
            return True
        rank, a, b = self.made[token]
        return self._compatible(a, b, rank)

    def _compatible(self, left: int, right: int, before: float = float("inf")) -> bool:
        """Whether merging leaves these neighbours apart until the merge of rank ``before``.

        Goes back in time: the part at the seam that was made last is taken apart, and at each
        state the seam must not have a merge that would have come before the next step. Of equal
        merges the left one comes first.
        """
        while True:
            if self.joins.get((left, right), before) < before:
                return False
            made_left, made_right = self.made.get(left), self.made.get(right)
            if made_left and (not made_right or made_left[0] > made_right[0]):
                before, left = made_left[0], made_left[2]
            elif made_right:
                before, right = made_right[0] + 0.5, made_right[1]
            else:
                return True

    def word_ids(self, word: bytes) -> list[int]:
        """The ids of one word."""
        spelled = word[:-1].decode("latin-1") + chr(256 + word[-1])
        last: list[tuple[int, int] | None] = [None] * (len(spelled) + 1)
        pairs = self.pairs
        for end, token in self.automaton.iter(spelled):
            if last[end + 1] is None:
                start = end + 1 - token[1]
                if start:
                    left = last[start][0]
                    key = left << 20 | token[0]
                    fits = pairs.get(key)
                    if fits is None:
                        fits = pairs[key] = self._compatible(left, token[0])
                    if not fits:
                        continue
                last[end + 1] = token
        ids, at = [], len(spelled)
        while at:
            token, size = last[at]
            ids.append(token)
            at -= size
        return ids[::-1]

    def words(self, text: str) -> list[bytes | int]:
        """The words of a text in order; a special token that is spelled out is its id."""
        if "<|" not in text:
            return self._plain_words(text)
        found: list[bytes | int] = []
        for part in self._split.split(text):
            found += [self.special[part]] if part in self.special else self._plain_words(part)
        return found

    def _plain_words(self, text: str) -> list[str | bytes]:
        if not _ODD.search(text):
            return _WORD.findall(text.lower())
        normal = self.library.normalizer.normalize_str(text)
        code = self.letters
        return [bytes(code[c] for c in piece) for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def _forget(self) -> None:
        self.places = {}
        self.ids = np.zeros(1 << 20, np.int32)
        self.starts, self.lengths, self.filled = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), 0

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of a string array without nulls, and the number of ids of each text."""
        found = [self.words(t.as_py()) for t in texts]
        flat = [w for words in found for w in words]
        get = self.places.get
        places = list(map(get, flat))
        if None in places:
            self._learn({w for w, p in zip(flat, places) if p is None}, flat)
            places = list(map(self.places.get, flat))
        places = np.array(places, np.int64)
        sizes = self.lengths[places]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        edges = np.concatenate([[0], np.cumsum([len(w) for w in found])]).astype(np.int64)
        return gather(self.ids, self.starts[places], sizes), np.diff(ends[edges])

    def _learn(self, new: set, wanted: list) -> None:
        if len(self.places) + len(new) > REMEMBERED:
            self._forget()
            new = set(wanted)
        if len(self.pairs) > REMEMBERED:
            self.pairs = {}
        for word in new:
            ids = [word] if isinstance(word, int) else self.word_ids(word.encode() if isinstance(word, str) else word)
            at = len(self.places)
            if at == len(self.starts):
                self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
            while self.filled + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.filled : self.filled + len(ids)] = ids
            self.starts[at], self.lengths[at] = self.filled, len(ids)
            self.filled += len(ids)
            self.places[word] = at

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The texts of flat ids: without a decoder the library joins token names by blanks."""
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int64))
        words = self.names.take(pa.array(ids))
        return pc.binary_join(pa.LargeListArray.from_arrays(offsets, words), pa.scalar(" ", pa.large_string()))


_known: dict[str, PrefixBpe] = {}


def coder(vocabulary: str = WORD_BPE) -> PrefixBpe:
    """The coder of this Python worker, kept between tasks."""
    if vocabulary not in _known:
        _known[vocabulary] = PrefixBpe(vocabulary)
    return _known[vocabulary]


def bpe_round_trip(docs: DataFrame, vocabulary: str = WORD_BPE) -> DataFrame:
    """One row per document: ``doc_id, ids, decoded``, the ids of the whole text and what they decode to.

    A null text is empty and has no ids. Texts are cut nowhere, so memory holds one batch or one
    long text. Repeated rows keep their rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(vocabulary)
        for batch in batches:
            at = 0
            for part in slices(batch.column(1), _BATCH_BYTES):
                ids, counts = bpe.encode(part)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                decoded = bpe.decode(ids, counts).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), lists, decoded], ["doc_id", "ids", "decoded"])
                at += len(part)

    rows = docs.select(column("doc_id").cast("long").alias("doc_id"), text_of())
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")
