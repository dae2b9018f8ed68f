"""Best-fit packing [op 2]: documents become token pieces, packed into sequences by swap-based local search.

Tokens are counted once, in Arrow batches; only a piece's place, length and checksum go on. Pieces are dealt
by hash into blocks of about ``BLOCK_PIECES`` and each block is packed by one task: best fit, longest first,
then a local search over all underfull sequences. It moves pieces, exchanges one for one, or two for one, whenever
that raises the sum of squared fills, so that the emptiest sequences drain and go, until none goes any more. More documents
make more blocks, never larger ones; a block wastes less than one sequence more than a single large block.

Defined results: a NULL or empty text is the separator alone (one token). Repeated rows are packed each.
An empty table gives an empty result. A NULL ``doc_id`` is kept. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
import json
import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, stored, text_of

MAX_TOKENS = 2048
SEPARATOR = 0
BLOCK_PIECES = 40_000
# The local search ends after so many rounds over all underfull sequences that empty none.
IDLE_ROUNDS = 8
SLICE_BYTES = 16_000_000
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
# Characters of which all libraries agree what is a letter, a number or a space.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-¬®-ɏ‐-‧‰-⁞₠-₿]*+")


class ByteBpe:
    """Token ids as the tokenizers library gives them for a byte-level vocabulary file.

    Texts of plain characters are encoded by tiktoken over the same vocabulary, which gives the same ids
    several times as fast; its ranks are the file's merges in order, which is checked. Texts with other
    characters, or with a special token's text, go to the tokenizers library.
    """

    def __init__(self, vocabulary: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        with open(vocabulary, encoding="utf-8") as file:
            model = json.load(file)["model"]
        names, ids = _byte_names(set(ByteLevel.alphabet())), model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if [ids["".join(m)] for m in merges] != list(range(len(names), len(names) + len(merges))):
            raise ValueError("the vocabulary's ids don't follow its merges")
        ranks = {bytes(names[c] for c in t): i for t, i in ids.items() if t not in self.special}
        self.fast = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if _PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.library.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()


def _byte_names(alphabet: set[str]) -> dict[str, int]:
    """The byte that each character of the byte-level alphabet stands for.

    Printable bytes stand for themselves; the others have the characters from 256 on, in order.
    """
    own = [b for b in range(256) if chr(b) in alphabet]
    others = [b for b in range(256) if chr(b) not in alphabet]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


def cut(ids: bytes, most: int = MAX_TOKENS) -> list[tuple[int, int, int]]:
    """(start, length, checksum) of each piece: only the first may be shorter than ``most``."""
    n = len(ids) // 4
    first = n % most or min(n, most)
    edges = [0, *range(first, n + 1, most)]
    return [
        (a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for a, b in zip(edges, edges[1:], strict=False) if b > a
    ]


def token_pieces(docs: DataFrame, vocabulary: str, pattern: str, most: int = MAX_TOKENS) -> DataFrame:
    """The pieces of all documents: doc_id, piece, start, length, ids_crc32."""
    end = np.asarray([SEPARATOR], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(vocabulary, pattern)
        for batch in pieces(batches, "text", SLICE_BYTES):
            rows: list[tuple] = []
            for name, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
                rows += [(name, k, *found) for k, found in enumerate(cut(bpe.encode(text) + end, most))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(_PIECE_TYPES)], _PIECE_NAMES
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, PIECE_SCHEMA
    )


_PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]
_PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def best_fit(lengths: list[int], most: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin that still takes it."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(most + 1)]
    gaps = 0  # bit g is set where by_gap[g] has a bin
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[item]
        fitting = gaps >> size
        if fitting:
            gap = (fitting & -fitting).bit_length() - 1 + size
            bin_ = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps &= ~(1 << gap)
            bins[bin_].append(item)
        else:
            gap, bin_ = most, len(bins)
            bins.append([item])
        left = gap - size
        if left:
            by_gap[left].append(bin_)
            gaps |= 1 << left
    return bins


def local_search(bins: list[list[int]], lengths: list[int], most: int) -> list[list[int]]:
    """Exchanges and moves between all underfull bins as long as they raise the sum of squared fills.

    Bins are looked at from the emptiest on. One gives a piece, or two, to a fuller bin and takes back nothing, a piece,
    or two for one, by the step that moves most; when it finds no step, the next bin follows. Every step raises a whole number that is
    bounded, so a round ends. Rounds go on until one changes nothing, ``IDLE_ROUNDS`` in a row empty no bin, or there
    are as few bins as the pieces' total needs. Pieces of equal length are
    one, and partners are looked up by what they have to give (:class:`_Partners`), so a step's cost depends on the
    number of lengths, not of bins.
    """
    filled = [sum(lengths[i] for i in b) for b in bins]
    full = [b for b, n in zip(bins, filled) if n >= most]
    loose = [b for b, n in zip(bins, filled) if n < most]
    contents = [Counter(lengths[i] for i in b) for b in loose]
    gaps = [most - sum(k * n for k, n in c.items()) for c in contents]
    least = -(-sum(most - g for g in gaps) // most)  # no packing has fewer bins
    idle, moved_any = 0, True
    while moved_any and idle < IDLE_ROUNDS and (before := sum(map(bool, contents))) > least:
        moved_any = False
        partners = _Partners(contents, gaps, most)
        for low in sorted(range(len(contents)), key=lambda k: -gaps[k]):
            partners.remove(low)
            while contents[low] and (step := partners.step(contents[low])):
                give, take, high = step
                for here, there, moved in ((low, high, give), (high, low, take)):
                    contents[here].subtract(moved)
                    contents[here] += Counter()  # without what is used up
                    contents[there].update(moved)
                gain = sum(give) - sum(take)
                gaps[low] += gain
                gaps[high] -= gain
                partners.change(high)
                moved_any = True
        idle = 0 if sum(map(bool, contents)) < before else idle + 1
    items: dict[int, list[int]] = {}
    for i in sorted((i for b in loose for i in b), reverse=True):
        items.setdefault(lengths[i], []).append(i)
    packed = [[items[k].pop() for k, n in sorted(c.items(), reverse=True) for _ in range(n)] for c in contents]
    return full + [b for b in packed if b]


class _Partners:
    """Underfull bins by what they can give: nothing, one piece, or two. For each total, the emptiest bin first."""

    def __init__(self, contents: list[Counter], gaps: list[int], most: int):
        self.contents, self.gaps = contents, gaps
        self.versions = [0] * len(contents)
        self.heaps: list[list[list[tuple]]] = [[[] for _ in range(most + 1)] for _ in range(2)]
        # A bin that gives t back can gain up to its gap, so it can be given up to gap + t.
        self.reach = np.full((2, most + 1), -1, np.int64)
        self.totals: list[tuple[set[int], set[int]]] = [(set(), set())] * len(contents)
        for k in range(len(contents)):
            self._add(k)

    def step(self, low: Counter) -> tuple[tuple[int, ...], tuple[int, ...], int] | None:
        """What a bin gives and takes back, and its partner; the step by which the partner gains most."""
        best, found = 0, None
        singles, pairs = _totals(low)
        for given, kinds in ((singles, (0, 1)), (pairs, (0,))):
            for v in given:
                for kind in kinds:
                    fits = self.reach[kind, :v] >= v
                    t = int(fits.argmax())
                    if fits[t] and v - t > best:
                        best, found = v - t, (v, given is pairs, t, kind)
        if found is None:
            return None
        v, two, t, kind = found
        high = self.heaps[kind][t][0][1]
        give = _pair(low, v) if two else (v,)
        take = _pair(self.contents[high], t) if kind else (t,) if t else ()
        return give, take, high

    def change(self, k: int) -> None:
        self.remove(k)
        if self.gaps[k] > 0:
            self._add(k)

    def remove(self, k: int) -> None:
        self.versions[k] += 1
        for kind, totals in enumerate(self.totals[k]):
            for t in totals:
                self._settle(kind, t)
        self.totals[k] = (set(), set())

    def _add(self, k: int) -> None:
        singles, pairs = _totals(self.contents[k])
        self.totals[k] = ({0, *singles}, pairs)
        for kind, totals in enumerate(self.totals[k]):
            for t in totals:
                heapq.heappush(self.heaps[kind][t], (-self.gaps[k], k, self.versions[k]))
                self._settle(kind, t)

    def _settle(self, kind: int, t: int) -> None:
        heap = self.heaps[kind][t]
        while heap and self.versions[heap[0][1]] != heap[0][2]:
            heapq.heappop(heap)
        self.reach[kind, t] = t - heap[0][0] if heap else -1


def _totals(content: Counter) -> tuple[set[int], set[int]]:
    """The lengths in a bin, and the sums of two of its pieces."""
    kinds = sorted(content)
    pairs = {a + b for i, a in enumerate(kinds) for b in kinds[i + 1 :]} | {2 * a for a in kinds if content[a] > 1}
    return set(kinds), pairs


def _pair(content: Counter, total: int) -> tuple[int, int]:
    return next((a, total - a) for a in sorted(content) if content[total - a] > (a == total - a))


def _packer(most: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def pack_block(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True)
        lengths = block["length"].tolist()
        bins = local_search(best_fit(lengths, most), lengths, most)
        sequence, offset = np.zeros(len(block), np.int64), np.zeros(len(block), np.int64)
        for k, items in enumerate(bins):
            at = 0
            for i in items:
                sequence[i], offset[i] = k, at
                at += lengths[i]
        block["sequence_id"] = (int(block["block"].iloc[0]) << 32) + sequence
        block["offset"] = offset
        return block.drop(columns="block")

    return pack_block


def pack(docs: DataFrame, vocabulary: str, pattern: str, most: int = MAX_TOKENS) -> DataFrame:
    """One row per piece, with the sequence it is in and its place there."""
    found = stored(token_pieces(docs, vocabulary, pattern, most), "token-pieces")
    blocks = max(1, math.ceil(found.count() / BLOCK_PIECES))
    dealt = found.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInPandas(
        _packer(most), f"{PIECE_SCHEMA}, sequence_id long, offset long"
    )
