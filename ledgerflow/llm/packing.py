"""Best-fit packing of tokenized documents by swap-based local search.

Tokens come from a byte-level BPE vocabulary file of the ``tokenizers`` library. Where its ids are in the order of its
merges, as usual, ``tiktoken`` encodes whole texts by the same vocabulary as ranks, which gives the same ids at less cost.
Other files, and texts whose runs of blanks are too long for that library, go the other way: the vocabulary's own pattern
splits a text into pieces that are encoded on their own, and a task keeps the ids of some hundred thousand pieces it has
met and calls the tokenizer's model for new ones only. The file's added tokens have their own ids, as in the tokenizer as
loaded; with ``plain`` the special ones among them are text like any other, as with ``encode_special_tokens``. Each document's ids end with id 0;
a document longer than a sequence is cut into full pieces, of which the first may be shorter.

The pieces are dealt to groups of about ``GROUP_PIECES`` by a running number, so that no key can make a group large; each
group is packed in one task. Full pieces are sequences of their own. The others start from a best-fit packing in
decreasing order; then local search takes the emptiest bins one after the other and tries to dissolve them: it moves
documents into other bins' gaps, and exchanges one or two of its documents for a longer one of another bin, as long as
that bin gets fuller, which increases the sum of squared fills. A bin that empties is a sequence saved. Groups end with
at most one poorly filled bin, so what grouping costs is less than one sequence in some ten thousand.

Cases: a null or empty text is the id 0 alone; repeated documents are packed each on its own; ties are broken by the
order of the pieces, so a rerun of a lost task gives the same sequences; an empty table gives none.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.storage import stored
from ledgerflow.llm.text import pick, slices

SEQUENCE = 2048
GROUP_PIECES = 40_000
#: Pieces in one generation of what a task remembers, some 80 MB; there are two generations.
CACHED_PIECES = 400_000
END_ID = 0

_PIECES = [
    T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
]


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, then 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def _ranks(path: str) -> dict[bytes, int] | None:
    """The vocabulary's tokens as bytes with their ids, if merging by least id is what its merges say."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    bytes_of = {letter: byte for byte, letter in _byte_letters().items()}
    found = {}
    for token, i in model["vocab"].items():
        if all(letter in bytes_of for letter in token):
            found[bytes(bytes_of[letter] for letter in token)] = i
    pairs = [merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"]]
    merged = [model["vocab"].get(a + b) for a, b in pairs]
    single = max((i for token, i in found.items() if len(token) == 1), default=-1)
    in_order = all(i is not None for i in merged) and all(a < b for a, b in zip([single, *merged], merged))
    return found if in_order and len(merged) + 256 >= len(found) and not model.get("ignore_merges") else None


class _Known(dict):
    """Ids of strings by a function, kept in two generations, so that frequent strings outlive rare ones."""

    def __init__(self, encode: Callable[[str], bytes], size: int) -> None:
        self._encode, self._size = encode, size
        self._older: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        ids = self._older.pop(text, None)
        if ids is None:
            ids = self._encode(text)
        if len(self) >= self._size:
            self._older = dict(self)
            self.clear()
        self[text] = ids
        return ids


class Encoder:
    """Ids of whole texts, equal to the tokenizer's own: its pattern splits the text, its model encodes each piece."""

    def __init__(self, path: str, pattern: str | None = None, plain: bool = True, ranked: bool = True) -> None:
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self._tokenize = tokenizer.model.tokenize
        added = {i: t for i, t in tokenizer.get_added_tokens_decoder().items() if not (plain and t.special)}
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values()):
            raise ValueError(f"added tokens of {path} that match by more than their own text")
        self._added = {t.content: array("I", [i]).tobytes() for i, t in added.items()}
        # longest first, as the library matches
        names = sorted(self._added, key=len, reverse=True)
        self._cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None
        self._letters = _byte_letters()
        self._split = regex.compile(pattern or public_tokenizers.PATTERN).findall
        self._ids = _Known(self._encode, CACHED_PIECES).__getitem__
        self._allowed = set(self._added)
        ranks = _ranks(path) if ranked else None
        self._ranked = ranks and self._by_ranks(ranks, pattern or public_tokenizers.PATTERN, added)

    @staticmethod
    def _by_ranks(ranks: dict[bytes, int], pattern: str, added: dict):
        import tiktoken

        special = {t.content: i for i, t in added.items()}
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def _encode(self, piece: str) -> bytes:
        tokens = self._tokenize(piece.encode().decode("latin-1").translate(self._letters))
        return array("I", [t.id for t in tokens]).tobytes()

    def _part(self, text: str) -> bytes:
        return b"".join(map(self._ids, self._split(text)))

    def __call__(self, text: str) -> np.ndarray:
        if self._ranked:
            try:
                return self._ranked.encode_to_numpy(text, allowed_special=self._allowed, disallowed_special=())
            except ValueError:  # a run of blanks beyond what the library's pattern matches at once
                pass
        if self._cut is None or not any(name in text for name in self._added):
            return np.frombuffer(self._part(text), "<u4")
        parts = self._cut(text)  # texts and added tokens in turn
        return np.frombuffer(b"".join(self._added[x] if i % 2 else self._part(x) for i, x in enumerate(parts)), "<u4")


def pieces_of(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", size: int = SEQUENCE, plain: bool = True
) -> DataFrame:
    """One row for each piece: the document, its number and place there, its length, a checksum of its ids."""
    source = pick(docs, doc_id, text).toDF("doc_id", "text")
    schema = T.StructType([source.schema["doc_id"], *_PIECES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path, plain=plain)
        for batch in batches:
            for part in slices(batch, "text"):
                rows: list[tuple[int, int, int, int, int]] = []
                for at, value in enumerate(part.column(1).to_pylist()):
                    ids = np.append(encode(value or ""), np.uint32(END_ID))
                    head = len(ids) % size or size
                    start, end, number = 0, head, 0
                    while start < len(ids):
                        rows.append((at, number, start, end - start, zlib.crc32(ids[start:end].tobytes())))
                        start, end, number = end, end + size, number + 1
                columns = list(zip(*rows, strict=True))
                kept = part.column(0).take(pa.array(columns[0], pa.int64()))
                arrays = [pa.array(c, t) for c, t in zip(columns[1:], (pa.int32(), *[pa.int64()] * 3), strict=True)]
                yield pa.RecordBatch.from_arrays([kept, *arrays], schema.names)

    return source.mapInArrow(run, schema)


class _Bins:
    """Bins of items with the gap of each, and the open bins by gap."""

    def __init__(self, sizes: np.ndarray, capacity: int) -> None:
        self.sizes, self.capacity = sizes.tolist(), capacity
        self.items: list[list[int]] = []
        self.gap: list[int] = []
        self.by_gap: list[set[int]] = [set() for _ in range(capacity + 1)]
        self.mask = 0  # bit g is set where some bin has gap g

    def place(self, b: int, gap: int) -> None:
        old = self.gap[b]
        self.by_gap[old].discard(b)
        if not self.by_gap[old]:
            self.mask &= ~(1 << old)
        self.gap[b] = gap
        self.by_gap[gap].add(b)
        self.mask |= 1 << gap

    def tightest(self, size: int) -> int:
        """The smallest gap of at least ``size``, or -1."""
        rest = self.mask >> size
        return size + (rest & -rest).bit_length() - 1 if rest else -1

    def best_fit(self) -> None:
        for item in sorted(range(len(self.sizes)), key=lambda i: (-self.sizes[i], i)):
            size = self.sizes[item]
            gap = self.tightest(size)
            if gap < 0 or gap == self.capacity:
                self.items.append([])
                self.gap.append(self.capacity)
                b, gap = len(self.items) - 1, self.capacity
                self.by_gap[gap].add(b)
                self.mask |= 1 << gap
            else:
                b = min(self.by_gap[gap])
            self.items[b].append(item)
            self.place(b, gap - size)

    def _give(self, source: int, target: int, out: list[int], back: int | None) -> None:
        """Move ``out`` from source to target, and ``back`` the other way."""
        moved = sum(self.sizes[i] for i in out) - (self.sizes[back] if back is not None else 0)
        for i in out:
            self.items[source].remove(i)
            self.items[target].append(i)
        if back is not None:
            self.items[target].remove(back)
            self.items[source].append(back)
        self.place(source, self.gap[source] + moved)
        self.place(target, self.gap[target] - moved)

    def _move(self, source: int) -> bool:
        for i in sorted(self.items[source], key=lambda i: -self.sizes[i]):
            self._hide(source)
            gap = self.tightest(self.sizes[i])
            self._show(source)
            if 0 <= gap < self.gap[source]:
                self._give(source, min(self.by_gap[gap] - {source}), [i], None)
                return True
        return False

    def _hide(self, b: int) -> None:
        own = self.by_gap[self.gap[b]]
        own.discard(b)
        if not own:
            self.mask &= ~(1 << self.gap[b])

    def _show(self, b: int) -> None:
        self.by_gap[self.gap[b]].add(b)
        self.mask |= 1 << self.gap[b]

    def _exchange(self, source: int, tried: int) -> bool:
        """Swap one or two of the source's items for a smaller one of a bin with a gap, as tightly as fits."""
        own = sorted(self.items[source], key=lambda i: -self.sizes[i])[:12]
        offers = [([i], self.sizes[i]) for i in own]
        offers += [([i, j], self.sizes[i] + self.sizes[j]) for k, i in enumerate(own) for j in own[k + 1 :]]
        looked = 0
        rest = self.mask >> 1 << 1
        while rest and looked < tried:
            gap = (rest & -rest).bit_length() - 1
            rest &= rest - 1
            if gap >= self.gap[source]:
                break
            for b in sorted(self.by_gap[gap])[:8]:
                if b == source:
                    continue
                looked += 1
                best = None
                for back in self.items[b]:
                    room = gap + self.sizes[back]
                    for out, size in offers:
                        if self.sizes[back] < size <= room and (best is None or size - self.sizes[back] > best[0]):
                            best = (size - self.sizes[back], out, back)
                if best:
                    self._give(source, b, best[1], best[2])
                    return True
        return False

    def local_search(self, tried: int = 64) -> None:
        """Dissolve the emptiest bins until all open ones have failed since the last change.

        Each step raises the sum of squared fills.
        """
        done: set[int] = set()
        lowest = -(-sum(self.sizes) // self.capacity)
        bins = sum(1 for x in self.items if x)
        while bins > lowest:
            gap = (self.mask & ((1 << self.capacity) - 1)).bit_length() - 1
            source = -1
            while gap > 0:
                left = self.by_gap[gap] - done
                if left:
                    source = min(left)
                    break
                gap = (self.mask & ((1 << gap) - 1)).bit_length() - 1
            if source < 0:
                return
            before = self.gap[source]
            while self.items[source] and (self._move(source) or self._exchange(source, tried)):
                pass
            if self.items[source]:
                if self.gap[source] > before:  # others have changed, so bins that failed may succeed now
                    done.clear()
                done.add(source)
            else:
                self._hide(source)
                bins -= 1
                done.clear()


def pack(sizes: np.ndarray, capacity: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset there of every item; bins are numbered from 0 without gaps."""
    bins = _Bins(sizes, capacity)
    bins.best_fit()
    bins.local_search()
    which, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for number, items in enumerate(x for x in bins.items if x):
        at = 0
        for i in sorted(items):
            which[i], offset[i] = number, at
            at += bins.sizes[i]
    return which, offset


def pack_documents(
    docs: DataFrame,
    path: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SEQUENCE,
    group_pieces: int = GROUP_PIECES,
    plain: bool = True,
) -> DataFrame:
    """Every piece of every document with its sequence and its offset there."""
    pieces = stored(pieces_of(docs, path or vocabulary_path(), doc_id, text, size, plain), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    # A running number within each partition, moved on by the partition's own hash: even groups whatever the values.
    number = F.monotonically_increasing_id()
    dealt = pieces.withColumn("group", F.pmod(number + F.xxhash64(F.shiftright(number, 33)), F.lit(groups)))
    schema = T.StructType(
        [*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def fill(rows: pa.Table) -> pa.Table:
        order = [(c, "descending") for c in ("length", "doc_id", "piece", "ids_crc32")]
        rows = rows.take(pc.sort_indices(rows, sort_keys=order))
        which, offset = pack(rows["length"].to_numpy(), size)
        base = rows["group"][0].as_py() << 32
        return rows.drop(["group"]).append_column("sequence_id", pa.array(which + base)).append_column("offset", pa.array(offset))

    return dealt.groupBy("group").applyInArrow(fill, schema).withColumnRenamed("doc_id", doc_id)
