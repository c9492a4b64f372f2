"""Line dedup: an exact set-similarity join over the words of lines.

A line is the set of its words. It is removed if an earlier line, in the order of doc_id, line number and
row, has a Jaccard similarity of at least ``THRESHOLD``. Rows are known by their place in the table, so those
that share a doc_id or have none are kept apart. Lines of one set are found by a digest of the
set. For the others, words are ordered by rarity, and two similar lines must share one of the
first words of that order (prefix filter). Only those words are shuffled; each goes with the line's
size, its place in the line, the word before it and parity bits of the words, 64 or, for longer lines, 128 or 256. Pairs are dropped when
sizes differ too much (length filter), when too few words are left after the shared one (positional filter),
or when more parity bits differ than words may. A pair whose words before the shared one are equal too is left to those, so
similar lines meet about once and not at every word. What remains is verified on the full sets.

Lines of very many words are first compared by a longer parity vector, which is stored once a line. Of many candidates of a
line only the nearest by parity are kept, of which the very nearest are verified first and the others if these do not match.
Lines that had more, and found no match among those, take part in another round with a higher limit, until no such
line is left; so the limit decides about work, not about results.

Rarity comes from a table of counts of fixed size, indexed by word hash. Words that many lines could share
are split into cells of line chunks, so no task gets a whole frequent word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from veil.llm.common import column, partitions, spread_join, stored, text_of
from veil.llm.tokens import give_back, slices

THRESHOLD = (4, 5)
MIN_WORDS = 1
# Smaller sets are similar to equal ones only: one word more or less than three leaves three quarters.
_PREFIX_WORDS = 4
# candidates of a line in the first round, how many times as many in the next, and those of a round that are verified before its others
LIMIT, GROWTH, _NEAREST = 64, 32, 2
_COUNT_BITS = 20
_CELL_ENTRIES = 150_000
_CHUNK_LINES = 1 << 16
_PAIRED = 256  # groups up to this size are paired by shifting the sorted entries
_FLUSH = 250_000
_HALF_WORDS, _QUARTER_WORDS, _NARROW_WORDS = 64, 128, 256  # so many words at most are told apart by 64, 128 and 256 bits
_PART_BYTES = 1 << 20
_HASHED_BYTES = 64  # longer words are hashed one by one
_SEED = 11
_KEY = ["none", "doc", "line", "row"]
_PARITY = ["sig", "half", "third", "fourth"]
# Filter tables have so many bits at least and at most (8 MB); only work depends on that.
_LEAST_FILTER_BITS, _FILTER_BITS = 22, 26
_PIECES = 16
_GONE = "_veil_removed_"
_ROW = "_veil_row"
# ``last`` is the word before in the order of the line, or 0
_ENTRY = np.dtype(
    [
        ("word", "<u4"), ("place", "<u4"), ("size", "<u4"), ("line", "<i4"), ("none", "u1"), ("doc", "<i8"), ("row", "<i8"),
        ("sig", "<u8"), ("half", "<u8"), ("third", "<u8"), ("fourth", "<u8"), ("last", "<u4"),
    ]
)


def _may_be_similar(x_size: int, x: bytes, y_size: int, y: bytes) -> bool:
    """Whether wide parity vectors, the longer one folded, differ in no more bits than similar sets may differ in words."""
    a, b = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    folded = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    both = np.int64(x_size + y_size)
    return int(np.bitwise_count(a ^ folded).sum()) <= both - 2 * _overlap(both)


def _hashes(words: pa.Array) -> np.ndarray:
    """A hash of each of some large strings, eight bytes of all of them at a time."""
    if not len(words):
        return np.zeros(0, np.uint64)
    edges = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    starts, lengths = edges[:-1] - edges[0], np.diff(edges)
    data = np.zeros(edges[-1] - edges[0] + 8, np.uint8)
    if len(data) > 8:
        data[:-8] = np.frombuffer(words.buffers()[2], np.uint8)[edges[0] : edges[-1]]
    eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    out = _mixed(lengths.astype(np.uint64), _SEED)
    own = np.flatnonzero((lengths > 0) & (lengths <= _HASHED_BYTES))
    for k in range(0, _HASHED_BYTES, 8):
        own = own[lengths[own] > k]
        unused = 8 * np.maximum(k + 8 - lengths[own], 0).astype(np.uint64)
        out[own] = _mixed(out[own] ^ (eights[starts[own] + k] << unused), k + 1)
    for i in np.flatnonzero(lengths > _HASHED_BYTES).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : starts[i] + lengths[i]].tobytes(), _SEED)
    return out


class Lines:
    """The lines of a batch of texts that have enough words: distinct word hashes, grouped by line.

    ``pick`` tells from the places of texts and the numbers of lines which lines to look at.
    """

    def __init__(self, texts: pa.Array, min_words: int, pick: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None):
        lines = pc.split_pattern(pc.utf8_lower(texts.cast(pa.large_string())), "\n")
        offsets = lines.offsets.to_numpy()
        per_text = np.diff(offsets)
        text_of_line = np.repeat(np.arange(len(per_text)), per_text)
        number = (np.arange(len(text_of_line)) - (offsets[:-1] - offsets[0])[text_of_line]).astype(np.int32)
        lines = lines.flatten()
        if pick is not None:
            picked = pick(text_of_line, number)
            lines, text_of_line, number = lines.filter(pa.array(picked)), text_of_line[picked], number[picked]
        words = pc.utf8_split_whitespace(lines)
        ends = words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        hashes = _hashes(coded.dictionary)
        owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        # one number per line and word, so that one sort brings a line's equal words together
        pairs = np.sort(owner << 32 | coded.indices.to_numpy().astype(np.int64))
        pairs = pairs[np.append(np.ones(min(1, len(pairs)), bool), pairs[1:] != pairs[:-1])]
        # white space at either end of a line gives an empty word, which is none
        pairs = pairs[(pc.binary_length(coded.dictionary).to_numpy() > 0)[pairs & 0xFFFFFFFF]]
        owner, tokens = pairs >> 32, hashes[pairs & 0xFFFFFFFF]
        sizes = np.bincount(owner, minlength=len(ends) - 1)
        enough = sizes >= min_words
        self.tokens = tokens[enough[owner]]
        self.sizes = sizes[enough]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.text, self.number = text_of_line[enough], number[enough]

    def parity(self) -> np.ndarray:
        """One bit vector per line in which each word flips a bit: it differs in no more bits than sets differ in words."""
        return self._reduce(np.bitwise_xor, np.uint64(1) << ((self.tokens >> np.uint64(32)) & np.uint64(63)))

    def parts(self) -> list[np.ndarray]:
        """Parts of the parity vector that make it twice as long, for lines of more than a few words, and again, for those
        of yet more: what half of the words flip; what a quarter and another quarter flip."""
        flips = np.uint64(1) << ((self.tokens >> np.uint64(32)) & np.uint64(63))
        half, other = ((self.tokens >> np.uint64(k)) & np.uint64(1) for k in (38, 39))
        long, longer = ((self.sizes > n).astype(np.uint64) for n in (_HALF_WORDS, _QUARTER_WORDS))
        of = lambda which, lines: self._reduce(np.bitwise_xor, flips * which) * lines
        return [of(half, long), of(other & ~half, longer), of(other & half, longer)]

    def sums(self) -> np.ndarray:
        """Equal rows for equal sets: two sums of independently mixed hashes."""
        return np.stack([self._reduce(np.add, _mixed(self.tokens, s)) for s in (1, 2)], axis=1)

    def digests(self) -> pa.Array:
        """The bytes of the sums."""
        return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(self.sizes), [None, pa.py_buffer(self.sums())]).cast(pa.binary())

    def wide(self) -> list[bytes | None]:
        """Parity of lines of many words over two to four bits a word, their number a power of two; none for other lines."""
        long = np.flatnonzero(self.sizes > _NARROW_WORDS)
        out: list[bytes | None] = [None] * len(self.sizes)
        if len(long):
            bits = np.zeros(len(self.sizes), np.int64)
            bits[long] = 2 << np.ceil(np.log2(self.sizes[long])).astype(np.int64)
            ends = np.cumsum(bits)
            owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
            own = bits[owner] > 0
            owner, place = owner[own], (self.tokens[own] >> np.uint64(8)).astype(np.int64)
            flips = np.bincount((ends - bits)[owner] + (place & (bits[owner] - 1)), minlength=ends[-1])
            packed = np.packbits(flips.astype(np.uint8) & 1).tobytes()
            for i, end in zip(long.tolist(), (ends[long] >> 3).tolist()):
                out[i] = packed[end - int(bits[i] >> 3) : end]
        return out

    def _reduce(self, ufunc, values: np.ndarray) -> np.ndarray:
        return ufunc.reduceat(values, self.starts) if len(self.starts) else np.zeros(0, np.uint64)


class Shingles(Lines):
    """Each whole text as one line whose words are its shingles of ``length`` words: in ASCII lower case, white space
    is ASCII. A shorter text is one shingle, and so is one without words."""

    def __init__(self, texts: pa.Array, min_words: int, length: int):
        # lower case first: ascii_lower of a slice that was cast gives shifted rows
        words = pc.ascii_split_whitespace(pc.ascii_lower(texts).cast(pa.large_string()))
        coded = words.flatten().dictionary_encode()
        hashes = _hashes(coded.dictionary)
        index = coded.indices.to_numpy()
        owner = np.repeat(np.arange(len(texts)), np.diff(words.offsets.to_numpy()))
        true = (pc.binary_length(coded.dictionary).to_numpy() > 0)[index]
        owner, word = owner[true], hashes[index[true]]
        n = np.bincount(owner, minlength=len(texts))
        start, at = (np.cumsum(n) - n)[owner], np.arange(len(owner))
        first = at[at - start <= np.maximum(n[owner] - length, 0)]
        end = start[first] + n[owner[first]]
        value = np.zeros(len(first), np.uint64)
        for k in range(length):
            there = first + k < end
            value[there] = _mixed(value[there] ^ word[first[there] + k], k + 1)
        bare = np.flatnonzero(n == 0)
        owner, value = np.append(owner[first], bare), np.append(value, np.zeros(len(bare), np.uint64))
        order = np.lexsort((value, owner))
        owner, value = owner[order], value[order]
        once = np.ones(len(owner), bool)
        once[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
        owner, value = owner[once], value[once]
        sizes = np.bincount(owner, minlength=len(texts))
        enough = sizes >= min_words
        self.tokens, self.sizes, self.text = value[enough[owner]], sizes[enough], np.flatnonzero(enough)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.number = np.zeros(len(self.text), np.int32)


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = x + np.uint64(0x9E3779B97F4A7C15 * salt % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _numbered(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text``: the place of the row in the table first."""
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")


def _parsed(
    batches: Iterator[pa.RecordBatch], min_words: int, shingle: int, wanted: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, pa.Array, Lines]]:
    """Batches of ``row, doc_id, text`` in parts: the row and doc_id of each line, and the lines.

    With ``shingle`` each text is one line of shingles of so many words. ``wanted`` is a filter table of lines.
    """
    for batch in batches:
        at = 0
        for part in slices(batch.column(2), _PART_BYTES):
            rows = batch.column(0).slice(at, len(part)).to_numpy()
            pick = None if wanted is None else lambda text, number, rows=rows: _among(wanted, _hash(number, rows[text]))
            lines = Shingles(part, min_words, shingle) if shingle else Lines(part, min_words, pick)
            if len(lines.sizes):
                own = pa.array(lines.text + at)
                yield batch.column(0).take(own).to_numpy(), batch.column(1).take(own), lines
            at += len(part)
            del lines


def line_table(docs: DataFrame, min_words: int = MIN_WORDS, shingle: int = 0) -> tuple[DataFrame, np.ndarray]:
    """``row, doc_id, line, size, words, wide`` of every line, ``words`` being a digest of its set of words and ``wide`` the
    parity vector of a long one; and how many lines hold words of each hash prefix. Both come from one reading of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _COUNT_BITS, np.int64)
        for rows, ids, lines in _parsed(batches, min_words, shingle):
            counts += np.bincount(_count_place(lines.tokens), minlength=len(counts))
            columns = [pa.array(rows), ids, pa.array(lines.number)]
            columns += [pa.array(lines.sizes.astype(np.int32)), lines.digests()]
            columns += [pa.array(lines.wide(), pa.binary()), pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)
        pieces = np.minimum(counts, 2**32 - 1).astype("<u4").reshape(16, -1)
        columns = [pa.nulls(16, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())]
        columns += [pa.array(range(16), pa.int32()), pa.array([p.tobytes() for p in pieces], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names)

    names = ["row", "doc_id", "line", "size", "words", "wide", "piece", "counts"]
    schema = "row long, doc_id long, line int, size int, words binary, wide binary, piece int, counts binary"
    both = stored(_numbered(docs).mapInArrow(run, schema), "lines")
    return both.where("piece IS NULL").drop("piece", "counts"), summed(both.where("piece IS NOT NULL").select("piece", "counts"))


def _count_place(tokens: np.ndarray) -> np.ndarray:
    """The places of words in the table of counts: the upper bits of their lower half, which entries keep."""
    return ((tokens & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - _COUNT_BITS)).astype(np.int64)


def summed(parts: DataFrame) -> np.ndarray:
    """Counters of a fixed number, from pieces ``piece int, counts binary`` of many tasks, added up in two levels."""

    def add(key: tuple, group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), "<u4").astype(np.uint64) for x in group.column("counts"))
        total = np.minimum(total, 2**32 - 1).astype("<u4")
        return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "piece int, counts binary"
    spread = parts.withColumn("_task", F.spark_partition_id() % 64)
    rows = spread.groupBy("piece", "_task").applyInArrow(add, schema).groupBy("piece").applyInArrow(add, schema)
    # 4 MB by default, whatever the input
    found = {r["piece"]: np.frombuffer(r["counts"], "<u4") for r in rows.collect()}
    return np.concatenate([found[i] for i in sorted(found)]) if found else np.zeros(1 << _COUNT_BITS, "<u4")


def _prefix_length(sizes: np.ndarray) -> np.ndarray:
    a, b = THRESHOLD
    return sizes + (-sizes * a) // b + 1


def _overlap(sizes: np.ndarray) -> np.ndarray:
    """Words that two sets must share, from the sum of their sizes."""
    a, b = THRESHOLD
    return -((-sizes * a) // (a + b))


def _entries(rows: np.ndarray, ids: pa.Array, lines: Lines, counts: np.ndarray, seen: dict, repeats: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Prefix entries, and how many lines may share each word.

    A line whose set an earlier line of this task has is left out: it is removed for that.
    """
    none, doc = ids.is_null().to_numpy(zero_copy_only=False), pc.fill_null(ids, 0).to_numpy()
    sums = lines.sums()
    new = np.zeros(len(lines.sizes), bool) if repeats is None else ~_among(repeats, sums[:, 0])
    for i in np.flatnonzero(~new).tolist():
        d = sums[i].tobytes()
        order = (none[i], doc[i], lines.number[i], rows[i])
        if d not in seen or order < seen[d]:
            seen[d] = order
            new[i] = True
    owner = np.repeat(np.arange(len(lines.sizes)), lines.sizes)
    own = new[owner]
    # rarest first: by count in steps of an eighth of its logarithm, then by hash
    steps = (np.log2(np.maximum(counts, 1)) * 7.9).astype(np.uint64)
    words = lines.tokens[own]
    keys = steps[_count_place(words)] << np.uint64(32) | words & np.uint64(0xFFFFFFFF)
    keys |= owner[own].astype(np.uint64) << np.uint64(40)
    keys.sort()
    sizes = lines.sizes[new]
    place = np.arange(len(keys)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    first = np.flatnonzero(place < np.repeat(_prefix_length(sizes), sizes))
    place, owner = place[first], np.repeat(np.flatnonzero(new), _prefix_length(sizes))
    out = np.zeros(len(first), _ENTRY)
    out["word"], out["place"], out["size"], out["line"] = keys[first] & np.uint64(0xFFFFFFFF), place, lines.sizes[owner], lines.number[owner]
    out["last"] = np.where(place > 0, keys[first - 1] & np.uint64(0xFFFFFFFF), 0)
    out["none"], out["doc"], out["row"] = none[owner], doc[owner], rows[owner]
    for c, bits in zip(_PARITY, [lines.parity(), *lines.parts()]):
        out[c] = bits[owner]
    return out, counts[_count_place(keys[first])]


def packed_entries(docs: DataFrame, counts: np.ndarray, cells: int, min_words: int = MIN_WORDS, shingle: int = 0, repeats: np.ndarray | None = None) -> DataFrame:
    """Prefix entries, packed by cell: ``cell, i, j, role, entries``. Cells of words that more lines share
    than a chunk holds have a number for each pair of chunks. ``repeats`` is a filter table of the sets that several
    lines have."""

    def pack(rows: np.ndarray, often: np.ndarray) -> Iterator[tuple]:
        cell = rows["word"] % np.uint32(cells)
        chunks = -(-often.astype(np.int64) // _CHUNK_LINES)
        yield from _by_cell(rows, cell, np.flatnonzero(chunks <= 1))
        split = chunks > 1
        rows, cell, chunks = rows[split], cell[split], chunks[split]
        own = (_mixed(rows["sig"] ^ rows["row"].view(np.uint64), 3) % chunks.astype(np.uint64)).astype(np.int64)
        places = np.stack([cell, chunks, own], axis=1)
        for c, n, k in np.unique(places, axis=0).tolist():
            data = rows[(places == (c, n, k)).all(axis=1)]
            for i in range(n):
                yield c, k + 1, i + 1, 1, data  # as earlier lines
                yield c, i + 1, k + 1, 2, data  # as later lines

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, waiting, often = {}, [], []
        for places, ids, lines in _parsed(batches, min_words, shingle):
            entries, n = _entries(places, ids, lines, counts, seen, repeats)
            waiting.append(entries), often.append(n)
            del entries
            if sum(map(len, waiting)) > _FLUSH:
                rows, n, waiting, often = np.concatenate(waiting), np.concatenate(often), [], []
                yield from _batches(pack(rows, n))
                del rows
        if waiting:
            yield from _batches(pack(np.concatenate(waiting), np.concatenate(often)))
        del seen, waiting, often
        give_back()

    return _numbered(docs).mapInArrow(run, "cell int, i int, j int, role int, n int, entries binary")


def _by_cell(rows: np.ndarray, cell: np.ndarray, own: np.ndarray) -> Iterator[tuple]:
    own = own[np.argsort(cell[own], kind="stable")]
    edges = np.flatnonzero(np.diff(cell[own])) + 1
    for a, b in zip([0, *edges], [*edges, len(own)]):
        if b > a:
            yield int(cell[own[a]]), 0, 0, 3, rows[own[a:b]]


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    names = ["cell", "i", "j", "role", "n", "entries"]
    types = [pa.int32()] * 5 + [pa.binary()]
    waiting = []
    for *place, entries in rows:
        # bytes of the same weight side by side compress well
        planes = entries.view(np.uint8).reshape(-1, _ENTRY.itemsize).T.tobytes()
        waiting.append((*place, len(entries), pa.compress(planes, "zstd", asbytes=True)))
        if len(waiting) == 256:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*waiting), types)], names)
            waiting = []
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*waiting), types)], names)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = pa.decompress(data, n * _ENTRY.itemsize, "zstd", asbytes=True)
    return np.frombuffer(np.frombuffer(planes, np.uint8).reshape(_ENTRY.itemsize, n).T.tobytes(), _ENTRY)


def _passes(e: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether entries of one word, of which ``i`` is the smaller line, can be of similar lines."""
    a, b = THRESHOLD
    small, large = e["size"][i], e["size"][j]
    both = small + large
    need = _overlap(both)
    fits = small * b >= large * a
    # those of one word before the shared one meet there, and no filter is stricter there
    fits &= (e["last"][i] != e["last"][j]) | (e["last"][i] == 0)
    fits &= np.minimum(small - e["place"][i], large - e["place"][j]) >= need
    left = np.flatnonzero(fits)
    fits[left] = _different_bits(e, i[left], j[left]) <= (both - 2 * need)[left]
    return fits


def _different_bits(e: dict[str, np.ndarray] | np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Different parity bits of entries: of 256 or 128 if both lines have so many, otherwise of 64."""
    whole = e["sig"][i] ^ e["sig"][j]
    out = np.bitwise_count(whole).astype(np.int64)
    small = np.minimum(e["size"][i], e["size"][j])
    at = np.flatnonzero(small > _HALF_WORDS)
    if len(at):
        half = e["half"][i[at]] ^ e["half"][j[at]]
        out[at] = np.bitwise_count(whole[at] ^ half).astype(np.int64) + np.bitwise_count(half)
        longer = np.flatnonzero(small[at] > _QUARTER_WORDS)
        at, half = at[longer], half[longer]
        third, fourth = (e[c][i[at]] ^ e[c][j[at]] for c in _PARITY[2:])
        quarters = (whole[at] ^ half ^ third, half ^ fourth, third, fourth)
        out[at] = sum(np.bitwise_count(q).astype(np.int64) for q in quarters)
    return out


def _before(rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the line of ``i`` is earlier than that of ``j``."""
    x, y = rows[i], rows[j]
    before, same = np.zeros(len(x), bool), np.ones(len(x), bool)
    for c in _KEY:
        before |= same & (x[c] < y[c])
        same &= x[c] == y[c]
    return before


def cell_pairs(rows: np.ndarray, role: np.ndarray, limit: int, asked: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidate pairs of one cell: places of the earlier and of the later line, at most ``limit`` of a later line and
    those with the fewest different parity bits first; and the places of lines that had or may have had more.

    ``role`` tells whether an entry may be an earlier line (1), a later one (2) or both; ``asked`` marks the later
    lines that are of interest.
    """
    order = np.argsort(rows["word"].astype(np.uint64) << np.uint64(32) | rows["size"])
    rows, role = rows[order], role[order]
    later = (role & 2 > 0) if asked is None else (role & 2 > 0) & asked[order]
    e = {c: rows[c].astype(np.int64) for c in ("word", "size", "place", "last")} | {c: np.ascontiguousarray(rows[c]) for c in _PARITY}
    edges = np.flatnonzero(np.diff(e["word"], prepend=-1, append=-1))
    run = np.repeat(np.diff(edges), np.diff(edges))
    found_x, found_y, more = [], [], []

    def add(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        forward = _before(rows, i, j)
        x, y = np.where(forward, i, j), np.where(forward, j, i)
        fits = (forward | _before(rows, j, i)) & (role[x] & 1 > 0) & later[y]
        return x[fits], y[fits]

    # entries of a word stand by size: each meets those after it until they are too large
    i = np.flatnonzero((run > 1) & (run <= _PAIRED))
    k = 0
    while len(i):
        k += 1
        i = i[i + k < len(rows)]
        i = i[(e["word"][i] == e["word"][i + k]) & (e["size"][i + k] * THRESHOLD[0] <= e["size"][i] * THRESHOLD[1])]
        near = i[_passes(e, i, i + k)]
        x, y = add(near, near + k)
        found_x.append(x), found_y.append(y)
    for first, end in zip(edges[:-1], edges[1:]):
        if end - first > _PAIRED:
            for x, y, rest in _block_pairs(e, rows, role, later, int(first), int(end), limit):
                found_x.append(x), found_y.append(y), more.append(rest)
    join = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
    x, y, more = join(found_x), join(found_y), join(more)
    line = np.zeros(len(rows), np.int64)
    met = np.zeros(len(rows), bool)
    met[x] = met[y] = met[more] = True
    line[met] = _line_numbers(rows[met])
    # each pair once, whatever words it shares
    pair, once = np.unique(line[y] << 32 | line[x], return_index=True)
    x, y = x[once], y[once]
    bits = _different_bits(e, x, y)
    chance = _mixed((line[x] << 32 | line[y]).view(np.uint64), 7)
    best = np.lexsort((chance, bits, line[y]))
    x, y = x[best], y[best]
    own = line[y]
    starts = np.flatnonzero(np.diff(own, prepend=-1))
    rank = np.arange(len(own)) - np.repeat(starts, np.diff(np.append(starts, len(own))))
    more = np.append(more, y[rank == limit])
    more = more[np.unique(line[more], return_index=True)[1]]
    return order[x[rank < limit]], order[y[rank < limit]], order[more]


def _block_pairs(e, rows, role, later, first: int, end: int, limit: int) -> Iterator[tuple]:
    """The pairs of a large group, block by block; a later line stops when it has ``limit`` candidates."""
    a, b = THRESHOLD
    size = e["size"][first:end]
    for at in range(first, end, 1024):
        y = np.arange(at, min(at + 1024, end))
        y = y[later[y]]
        if not len(y):
            continue
        count = np.zeros(end - first, np.int64)
        low = first + int(np.searchsorted(size * b, e["size"][y[0]] * a, "left"))
        high = first + int(np.searchsorted(size * a, e["size"][y[-1]] * b, "right"))
        for x0 in range(low, high, 1024):
            x = np.arange(x0, min(x0 + 1024, high))
            i, j = (m.ravel() for m in np.meshgrid(y, x, indexing="ij"))
            small, large = np.minimum(i, j), np.maximum(i, j)
            near = np.flatnonzero(_passes(e, small, large) & (role[j] & 1 > 0))
            near = near[_before(rows, j[near], i[near])]
            px, py = j[near], i[near]
            np.add.at(count, py - first, 1)
            full = count[y - first] >= limit
            yield px, py, y[full]
            y = y[~full]
            if not len(y):
                break


def _line_numbers(rows: np.ndarray) -> np.ndarray:
    """Numbers of the lines of entries, in the order of lines."""
    order = np.lexsort([rows[c] for c in reversed(_KEY)])
    own = rows[order]
    changed = np.zeros(len(rows), bool)
    for c in _KEY:
        changed[1:] |= own[c][1:] != own[c][:-1]
    out = np.zeros(len(rows), np.int64)
    out[order] = np.cumsum(changed)
    return out


def candidates(packed: DataFrame, limit: int, asked: np.ndarray | None = None) -> DataFrame:
    """Pairs of an earlier line ``x`` and a later one ``y`` that pass all filters; ``x.line`` is -1 for a ``y`` that had more.
    ``long`` tells pairs whose parity vectors are longer than those of entries, ``nth`` counts a later line's pairs from the nearest.

    ``asked`` is a filter table of the later lines of interest.
    """

    def run(group: pa.Table) -> pa.Table:
        parts, roles = [], []
        for role, n, data in zip(*(group.column(c).to_pylist() for c in ("role", "n", "entries"))):
            parts.append(_unpacked(data, n)), roles.append(np.full(n, role))
        rows, role = np.concatenate(parts), np.concatenate(roles)
        wanted = None
        if asked is not None:
            wanted = _among(asked, _hash(rows["line"], rows["row"].copy()))
        x, y, more = cell_pairs(rows, role, limit, wanted)
        earlier = np.concatenate([rows[x], np.zeros(len(more), _ENTRY)])
        earlier["line"][len(x) :] = -1
        columns = {}
        for side, own in (("x", earlier), ("y", rows[np.append(y, more)])):
            columns[f"{side}_none"] = pa.array(own["none"].astype(bool))
            columns[f"{side}_doc"], columns[f"{side}_line"] = pa.array(own["doc"].copy()), pa.array(own["line"].copy())
            columns[f"{side}_row"] = pa.array(own["row"].copy())
        bits = np.append(_different_bits(rows, x, y), np.zeros(len(more), np.int64))
        long = np.append(np.minimum(rows["size"][x], rows["size"][y]) > _NARROW_WORDS, np.zeros(len(more), bool))
        del parts, roles
        give_back()
        return pa.table(columns | {"bits": pa.array(bits.astype(np.int32)), "long": pa.array(long)})

    sides = [", ".join(f"{s}_{k}" for k in ("none boolean", "doc long", "line int", "row long")) for s in "xy"]
    flat = packed.groupBy("cell", "i", "j").applyInArrow(run, ", ".join([*sides, "bits int", "long boolean"]))
    both = flat.select(*[F.struct(*[F.col(f"{s}_{k}").alias(k) for k in _KEY]).alias(s) for s in "xy"], "bits", "long")
    # over all cells, the best of a line again; a line has more if any cell says so or a candidate is left over
    ways = both.groupBy("y", "x").agg(F.min("bits").alias("bits"), F.max("long").alias("long"))
    best = W.partitionBy("y").orderBy(F.col("x.line") < 0, "bits", F.xxhash64("x", "y"), "x")
    ranked = ways.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= limit + 1)
    left_over = (F.col("x.line") < 0) | (F.col("_n") > limit)
    none = F.struct(*[F.lit(v).cast(t).alias(k) for k, v, t in zip(_KEY, (False, 0, -1, 0), ("boolean", "long", "int", "long"))])
    pair = [F.when(left_over, none).otherwise(F.col("x")).alias("x"), "y", (F.col("long") & ~left_over).alias("long")]
    return ranked.select(*pair, F.when(left_over, 0).otherwise(F.col("_n")).alias("nth")).distinct()


def _hash(line: np.ndarray, row: np.ndarray) -> np.ndarray:
    return _mixed(row.view(np.uint64) ^ _mixed(line.astype(np.uint64), 4), 5)


def _row_hash(row: np.ndarray) -> np.ndarray:
    return _mixed(row.view(np.uint64), 6)


def _set_hash(words: pa.Array) -> np.ndarray:
    """The first half of each digest of a set of words."""
    return np.frombuffer(b"".join(words.to_pylist()), np.uint64)[::2]


def _word_hash(word: np.ndarray) -> np.ndarray:
    return word.astype(np.uint64) << np.uint64(32)


def _among(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether hashes may be among those a filter table was made of."""
    at = (hashes >> np.uint64(64 - _filter_bits(table))).astype(np.int64)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0


def _filter_bits(table: np.ndarray) -> int:
    return int(8 * len(table)).bit_length() - 1


def _filter(rows: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], expected: int) -> np.ndarray:
    """A filter table of the hashes that batches of the rows give. It has about eight bits for each of the ``expected``
    ones, within bounds, so it stays small whatever the input; a table too full only lets more through.

    Every task marks a table of its own and hands over the marked pieces, which are combined in two levels.
    """
    bits = min(max(int(8 * expected).bit_length(), _LEAST_FILTER_BITS), _FILTER_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.zeros((1 << bits) // 8, np.uint8)
        for batch in batches:
            at = hashes(batch) >> np.uint64(64 - bits)
            np.bitwise_or.at(marked, (at >> np.uint64(3)).astype(np.int64), np.uint8(128) >> (at & np.uint64(7)).astype(np.uint8))
        pieces = marked.reshape(_PIECES, -1)
        some = np.flatnonzero(pieces.any(axis=1))
        marks = pa.array([p.tobytes() for p in pieces[some]], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), marks], ["piece", "marks"])

    def either(key: tuple, group: pa.Table) -> pa.Table:
        marks = np.zeros((1 << bits) // 8 // _PIECES, np.uint8)
        for x in group.column("marks"):
            marks |= np.frombuffer(x.as_py(), np.uint8)
        return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()), "marks": pa.array([marks.tobytes()], pa.binary())})

    schema = "piece int, marks binary"
    spread = rows.mapInArrow(run, schema).withColumn("_task", F.spark_partition_id() % 64)
    whole = spread.groupBy("piece", "_task").applyInArrow(either, schema).groupBy("piece").applyInArrow(either, schema)
    table = np.zeros((_PIECES, (1 << bits) // 8 // _PIECES), np.uint8)
    # 2**_FILTER_BITS bits at most, whatever the input
    for r in whole.collect():
        table[r["piece"]] = np.frombuffer(r["marks"], np.uint8)
    return table.ravel()


def _line_filter(keys: DataFrame) -> np.ndarray:
    """A table that says of most lines that they are not among the stored keys."""
    places = keys.select("line_key.line", "line_key.row")
    return _filter(places, lambda b: _hash(b.column(0).to_numpy(), b.column(1).to_numpy()), keys.count())


def _row_filter(keys: DataFrame) -> np.ndarray:
    """The same for the rows of the stored keys."""
    return _filter(keys.select("line_key.row"), lambda b: _row_hash(b.column(0).to_numpy()), keys.count())


def _line_words(docs: DataFrame, keys: DataFrame, min_words: int, shingle: int) -> DataFrame:
    """``line_key, set``: the word hashes of the lines among the keys, and of few others."""
    wanted, owners = _line_filter(keys), _row_filter(keys)

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_among(owners, _row_hash(batch.column(0).to_numpy()))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for places, ids, lines in _parsed(few(batches), min_words, shingle, wanted):
            none, doc = ids.is_null().to_numpy(zero_copy_only=False), pc.fill_null(ids, 0).to_numpy()
            at = np.flatnonzero(_among(wanted, _hash(lines.number, places)))
            sets = [lines.tokens[a : a + n].tobytes() for a, n in zip(lines.starts[at].tolist(), lines.sizes[at].tolist())]
            columns = [pa.array(none[at]), pa.array(doc[at]), pa.array(lines.number[at]), pa.array(places[at]), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*_KEY, "set"])

    rows = _numbered(docs).mapInArrow(run, "none boolean, doc long, line int, row long, set binary")
    return rows.select(F.struct(*_KEY).alias("line_key"), "set")


def _narrowed(packed: DataFrame, asked: np.ndarray) -> DataFrame:
    """The entries of words that lines of a filter table have; the others can be no candidates of theirs."""

    def words(batch: pa.RecordBatch) -> np.ndarray:
        own = [np.zeros(0, np.uint32)]
        for n, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows = _unpacked(data, n)
            own.append(rows["word"][_among(asked, _hash(rows["line"], rows["row"].copy()))])
        return _word_hash(np.concatenate(own))

    # a line asked for has no more than a few entries for each bit of its filter table
    table = _filter(packed.select("n", "entries"), words, len(asked))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for *place, n, data in zip(*(batch.column(i).to_pylist() for i in range(6))):
                own = _unpacked(data, n)
                own = own[_among(table, _word_hash(own["word"]))]
                if len(own):
                    rows.append((*place, own))
            yield from _batches(iter(rows))

    return packed.mapInArrow(keep, packed.schema)


def _plausible(pairs: DataFrame, wide: DataFrame) -> DataFrame:
    """The pairs without those of long lines whose wide parity vectors differ too much; sets are far larger than these.

    Of pairs with a column ``long`` only those are looked at for which it is true.
    """
    if "long" in pairs.columns:
        return _plausible(pairs.where("long").select("x", "y"), wide).unionByName(pairs.where("NOT long").select("x", "y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [batch.column(i).to_pylist() for i in range(2, 6)]
            keep = [x is None or y is None or _may_be_similar(n, x, m, y) for n, x, m, y in zip(*values)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in (0, 1)], ["x", "y"]).filter(pa.array(keep, pa.bool_()))

    for side in "xy":
        own = wide.select(F.col("line_key").alias(side), F.col("size").alias(f"{side}_size"), F.col("wide").alias(f"{side}_wide"))
        pairs = pairs.join(own, side, "left")
    key = "struct<none: boolean, doc: bigint, line: int, row: bigint>"
    return pairs.select("x", "y", "x_size", "x_wide", "y_size", "y_wide").mapInArrow(run, f"x {key}, y {key}")


def _verified(docs: DataFrame, pairs: DataFrame, min_words: int, shingle: int) -> DataFrame:
    """``line_key`` of the later lines of pairs that are similar by their full sets."""
    asks = pairs.select(F.col("x").alias("line_key"), "x", "y", F.lit(True).alias("early")).unionByName(
        pairs.select(F.col("y").alias("line_key"), "x", "y", F.lit(False).alias("early"))
    )
    words = _line_words(docs, stored(asks.select("line_key").distinct(), "candidate-lines"), min_words, shingle)
    # of equally near candidates each line has taken one by chance, so no line is asked for by a great share of all
    both = asks.join(words, "line_key").groupBy("x", "y").agg(
        F.max(F.when(F.col("early"), F.col("set"))).alias("x_set"), F.max(F.when(~F.col("early"), F.col("set"))).alias("y_set")
    )
    key = "line_key struct<none: boolean, doc: bigint, line: int, row: bigint>"
    return both.select("y", "x_set", "y_set").mapInArrow(_similar, key).distinct()


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        keep = []
        for x, y in zip(a, b):
            both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
            both.sort()
            keep.append(np.count_nonzero(both[1:] == both[:-1]) >= _overlap(len(both)))
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep, pa.bool_()))], ["line_key"])


def near_later_lines(
    docs: DataFrame, wide: DataFrame, counts: np.ndarray, repeats: np.ndarray, entries: int, min_words: int = MIN_WORDS, shingle: int = 0,
    known: DataFrame | None = None,
) -> DataFrame:
    """``line_key`` of lines with a similar earlier line, but for lines whose set an earlier line has.

    No candidates are verified for the ``known`` ones, which are among the result.
    """
    cells = max(partitions(docs.sparkSession), -(-entries // _CELL_ENTRIES))
    packed = stored(packed_entries(docs, counts, cells, min_words, shingle, repeats), "prefix-entries")
    limit, pending, asked, matched = LIMIT, None, None, [] if known is None else [known]
    while True:
        found = candidates(packed if asked is None else _narrowed(packed, asked), limit, asked)
        if pending is not None:
            found = found.join(pending, "y", "left_semi")
        elif known is not None:
            found = found.join(known.withColumnRenamed("line_key", "y"), "y", "left_anti")
        found = stored(found, "candidates")
        nearest = stored(_plausible(found.where(f"x.line >= 0 AND nth <= {_NEAREST}"), wide), "pairs")
        hits = stored(_verified(docs, nearest, min_words, shingle), "similar-lines")
        matched.append(hits)
        others = found.where(f"nth > {_NEAREST}").join(hits.withColumnRenamed("line_key", "y"), "y", "left_anti")
        others = stored(_plausible(others, wide), "pairs")
        if not others.isEmpty():
            matched.append(stored(_verified(docs, others, min_words, shingle), "similar-lines"))
            hits = hits.unionByName(matched[-1])
        more = found.where("x.line < 0").select("y").distinct()
        pending = stored(more.join(hits.withColumnRenamed("line_key", "y"), "y", "left_anti"), "pending")
        if pending.isEmpty():
            break
        asked = _line_filter(pending.withColumnRenamed("y", "line_key"))
        limit *= GROWTH
    out = matched[0]
    for m in matched[1:]:
        out = out.unionByName(m)
    return out.distinct()


def removed_lines(docs: DataFrame, min_words: int = MIN_WORDS, shingle: int = 0, pairs: DataFrame | None = None) -> DataFrame:
    """``line_key`` of every line with an equal or similar earlier line, from ``doc_id, text``.

    ``pairs`` of an earlier line ``x`` and a later one ``y``, found in another way, are verified first; for a line that one
    of them settles no others are looked for.
    """
    table, counts = line_table(docs, min_words, shingle)
    lines = table.withColumn(
        "line_key",
        F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("doc"), "line", "row"),
    )
    place = F.col("line_key")
    wide = lines.where("wide IS NOT NULL").select("line_key", "size", "wide")
    # most sets are met once: only the lines of others, and few more, are shuffled
    shared = lines.groupBy("words").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("words")
    repeats = _filter(shared, lambda b: _set_hash(b.column(0)), lines.count())

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_among(repeats, _set_hash(batch.column(0)))))

    key = "line_key struct<none: boolean, doc: bigint, line: int, row: bigint>"
    few = stored(lines.select("words", "line_key").mapInArrow(some, f"words binary, {key}"), "repeated-lines")
    sets = few.groupBy("words").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = stored(sets.where("n > 1"), "repeated-sets")
    equal = spread_join(few, repeated, "words", "n").where(place > F.col("first")).select("line_key")
    a, b = THRESHOLD
    near_words = max(min_words, _PREFIX_WORDS)
    prefix = F.when(F.col("size") >= near_words, F.col("size") - F.ceil(F.col("size") * a / b) + 1)
    entries = lines.agg(F.sum(prefix)).first()[0] or 0
    known = None
    if pairs is not None:
        likely = stored(_plausible(pairs, wide), "given-pairs")
        known = stored(_verified(docs, likely, min_words, shingle), "settled-lines")
    return equal.unionByName(near_later_lines(docs, wide, counts, repeats, int(entries), near_words, shingle, known)).distinct()


def _per_row(docs: DataFrame, min_words: int) -> DataFrame:
    """``_ROW, _GONE``: the numbers of the removed lines of each row that has any, no more than the row has lines."""
    plain = docs.select(column("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    gone = removed_lines(plain, min_words).groupBy(F.col("line_key.row").alias(_ROW))
    return gone.agg(F.array_sort(F.collect_list("line_key.line")).alias(_GONE))


def later_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_removed, removed``, the numbers from 0 of its lines that have an
    equal or similar earlier line, as :func:`line_dedup` removes them. Texts are not shuffled.
    """
    n_lines = F.when(column("text").isNull(), 0).otherwise(F.size(F.split(text_of(), "\n")))
    rows = docs.select(F.monotonically_increasing_id().alias(_ROW), column("doc_id").cast("long").alias("doc_id"), n_lines.alias("n_lines"))
    removed = F.coalesce(_GONE, F.array().cast("array<int>"))
    joined = rows.join(_per_row(docs, min_words), _ROW, "left")
    return joined.select("doc_id", "n_lines", F.size(removed).alias("n_removed"), removed.alias("removed"))


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS, counts: bool = True) -> DataFrame:
    """The documents with later similar lines taken out of their ``text``, all columns as before, and with
    ``counts`` also ``n_lines, n_removed``, which replace columns of these names.

    Words are what white space separates, in lower case. Lines with fewer than ``min_words`` distinct words are
    kept. A null text stays null. A null doc_id comes after all others; of lines that share a doc_id and a
    line number, that of the row that comes first in the table is the earlier one. ``docs`` is read several times
    and must give its rows in the same places, as a stored table does.
    """
    kept = [f for f in docs.schema.fields if not counts or f.name not in ("n_lines", "n_removed")]
    place = [f.name for f in kept].index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lost = batch.column(place), batch.column(len(kept))
            values, removed = texts.to_pylist(), np.zeros(batch.num_rows, np.int32)
            n_lines = [0 if v is None else v.count("\n") + 1 for v in values]
            for i in np.flatnonzero(lost.is_valid().to_numpy(zero_copy_only=False)).tolist():
                drop = set(lost[i].as_py())
                values[i] = "\n".join(x for n, x in enumerate(values[i].split("\n")) if n not in drop)
                removed[i] = len(drop)
            columns = [batch.column(k) for k in range(len(kept))]
            columns[place] = pa.array(values, texts.type)
            if counts:
                columns += [pa.array(n_lines, pa.int32()), pa.array(removed)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    schema = StructType(kept + [StructField(c, IntegerType()) for c in ("n_lines", "n_removed") if counts])
    placed = docs.withColumn(_ROW, F.monotonically_increasing_id())
    joined = placed.join(_per_row(docs, min_words).hint("shuffle_hash"), _ROW, "left").select(*[column(f.name) for f in kept], _GONE)
    return joined.mapInArrow(cut, schema)


def keep_dissimilar(docs: DataFrame, shingle: int, pairs: DataFrame | None = None) -> DataFrame:
    """The documents, all columns as they are, without those that have an earlier document of similar shingles.

    Of any two documents whose sets of shingles have a Jaccard similarity of at least ``THRESHOLD`` the later one goes,
    in the order of doc_id, null last, and row. Texts without words are equal. ``docs`` is read several times and
    must give its rows in the same places, as a stored table does. Those of the ``pairs`` ``x, y`` that are similar settle
    their later document before others are looked for.
    """
    plain = docs.select(column("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    gone = removed_lines(plain, 1, shingle, pairs).select(F.col("line_key.row").alias(_ROW))
    placed = docs.withColumn(_ROW, F.monotonically_increasing_id())
    return placed.join(gone.hint("shuffle_hash"), _ROW, "left_anti").drop(_ROW)
