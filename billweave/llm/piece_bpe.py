"""SentencePiece encoding and decoding [op 10]: byte-pair merges of all distinct words at once, in numpy rounds.

A text is cut into words where no piece of the model reaches across: before spaces, between letters and
punctuation, around digits and line feeds. That no piece is cut is checked when the model is loaded. The distinct words of a batch that are not yet known are laid out in one flat symbol array. Each
round finds every word's best pair (smallest rank, leftmost of equals) with a segmented minimum, merges these
pairs in all words at once, closes the gaps, and puts words without a further pair aside. That is exactly the
order in which the library merges. Words of over ``LONG_WORD`` symbols would need many rounds; they are merged
with a priority queue instead, to the same result. Characters without a piece become byte pieces.

Decoding joins the pieces' texts, turns the space mark into a space and drops the one space that encoding put
in front.

Defined results: a NULL or empty text has no ids and decodes to the empty text. Repeated rows are encoded
each. Empty tables, NULL ids and other columns are fine.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, text_of

MARK = "▁"
LONG_WORD = 200
SLICE_BYTES = 8_000_000
REMEMBERED_WORDS = 700_000
_NONE = np.int32(2**31 - 1)


class PieceBpe:
    """Encoder and decoder for a byte-pair model with byte fallback, a leading space mark and no normalisation."""

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        source = SentencePieceProcessor(model_file=model)
        self.size = source.get_piece_size()
        self.pieces = [source.id_to_piece(i) for i in range(self.size)]
        byte = [source.is_byte(i) for i in range(self.size)]
        plain = [
            not (byte[i] or source.is_control(i) or source.is_unknown(i) or source.is_unused(i))
            for i in range(self.size)
        ]
        ids = {p: i for i, p in enumerate(self.pieces) if plain[i]}
        self.byte_ids = [0] * 256
        for i, p in enumerate(self.pieces):
            if byte[i]:
                self.byte_ids[int(p[3:5], 16)] = i
        self.byte_of = {i: v for v, i in enumerate(self.byte_ids)}
        # Equal scores have equal rank: of such pairs the leftmost goes first.
        scores = np.asarray([source.get_score(i) for i in range(self.size)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        merges = {
            (ids[p[:k]], ids[p[k:]]): i
            for p, i in ids.items()
            for k in range(1, len(p))
            if p[:k] in ids and p[k:] in ids
        }
        self.merges = merges
        self._index(merges)
        letters = {c for p in ids for c in p}
        self.char_ids = np.full(0x110000, -1, np.int32)
        for c in letters & ids.keys():
            self.char_ids[ord(c)] = ids[c]
        with_letters = {c for p in ids if any(x.isalpha() for x in p) for c in p}
        alone = "".join(re.escape(c) for c in sorted(letters - with_letters - {MARK}) if c not in "0123456789\n")
        self.words = re.compile(f"{MARK}*[^{MARK}{alone}0-9\n]+|{MARK}*[{alone}]+|{MARK}+|[0-9]|\n+")
        if any(self.words.findall(p) != [p] for p in ids):
            raise ValueError(f"pieces reach across words: {[p for p in ids if self.words.findall(p) != [p]][:9]}")
        self.id_texts = [str(i) for i in range(self.size)]
        self.texts = [p.replace(MARK, " ") if plain[i] else None for i, p in enumerate(self.pieces)]
        # Ids as text and decoded text of each word.
        self.known: dict[str, tuple[str, str]] = {}
        # What stands between two spaces is numbered; by number its ids as text. Decoded texts that
        # differ from the original are kept by number too.
        self.numbers: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        self.spaced_ids: list[str] = []
        self.odd: dict[int, str] = {}

    def forget(self) -> None:
        self.known.clear()
        self.numbers = defaultdict(itertools.count().__next__)
        self.spaced_ids, self.odd = [], {}

    def learn(self, texts: list[list[str]]) -> None:
        """Encodes the words that are not known yet."""
        new: set[str] = set()
        for words in texts:
            new.update(words)
        fresh = list(new.difference(self.known))
        short = [w for w in fresh if len(w) <= LONG_WORD]
        for word, ids in zip(short, self.merge_rounds(short), strict=True):
            self._remember(word, ids)
        for word in fresh:
            if len(word) > LONG_WORD:
                self._remember(word, self.merge_queued(word))

    def _remember(self, word: str, ids: list[int]) -> None:
        if min(ids) < 0:
            ids = [i for s in ids for i in ((s,) if s >= 0 else (self.byte_ids[b] for b in chr(-s - 1).encode()))]
        self.known[word] = ",".join([self.id_texts[i] for i in ids]), self.decode_word(ids)

    def decode_word(self, ids: list[int]) -> str:
        texts = [self.texts[i] for i in ids]
        if None not in texts:
            return "".join(texts)
        out = [bytes((self.byte_of[i],)) if t is None else t.encode() for i, t in zip(ids, texts, strict=True)]
        return b"".join(out).decode("utf-8", "replace")

    def _index(self, merges: dict[tuple[int, int], int]) -> None:
        """A hash table of pairs, probed for whole arrays at once."""
        bits = max(4, (4 * len(merges)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.merged = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        keys = np.asarray([a * self.size + b for a, b in merges], np.int64)
        for key, slot, piece in zip(keys.tolist(), self._slots(keys).tolist(), merges.values(), strict=True):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & self.mask
            self.keys[slot], self.merged[slot] = key, piece

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged piece and its rank for each pair; rank _NONE where there is none."""
        piece, rank = np.zeros(len(left), np.int32), np.full(len(left), _NONE, np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        wanted = left[open_].astype(np.int64) * self.size + right[open_]
        slot = self._slots(wanted)
        while len(open_):
            there = self.keys[slot]
            hit = there == wanted
            found = self.merged[slot[hit]]
            piece[open_[hit]], rank[open_[hit]] = found, self.rank[found]
            on = ~hit & (there >= 0)
            open_, wanted, slot = open_[on], wanted[on], (slot[on] + 1) & self.mask
        return piece, rank

    def merge_rounds(self, words: list[str]) -> list[list[int]]:
        """Symbols of each word: piece ids, or minus the code point less one where there is no piece."""
        if not words:
            return []
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sym = self.char_ids[points]
        sym = np.where(sym >= 0, sym, -points.astype(np.int64) - 1).astype(np.int32)
        owner = np.repeat(np.arange(len(words), dtype=np.int32), [len(w) for w in words])
        done_sym, done_owner = [], []
        pair = np.zeros(len(sym), np.int32)
        rank = np.full(len(sym), _NONE, np.int32)
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        pair[inside], rank[inside] = self._ranks(sym[inside], sym[inside + 1])
        while len(sym):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(sym)]))
            going = best != _NONE
            if not going.all():
                done_sym.append(sym[~going])
                done_owner.append(owner[~going])
                sym, owner, pair, rank, best = sym[going], owner[going], pair[going], rank[going], best[going]
            hits = np.flatnonzero(rank == best)
            if not len(hits):
                break
            first = hits[np.r_[True, owner[hits[1:]] != owner[hits[:-1]]]]
            sym[first] = pair[first]
            keep = np.ones(len(sym), bool)
            keep[first + 1] = False
            sym, owner, pair, rank = sym[keep], owner[keep], pair[keep], rank[keep]
            changed = first - np.arange(len(first))  # each earlier merge has closed one gap
            rank[changed] = _NONE
            for at in (changed[changed > 0] - 1, changed[changed < len(sym) - 1]):
                at = at[owner[at] == owner[at + 1]]
                pair[at], rank[at] = self._ranks(sym[at], sym[at + 1])
        all_sym, all_owner = np.concatenate(done_sym), np.concatenate(done_owner)
        order = np.argsort(all_owner, kind="stable")
        edges = np.searchsorted(all_owner[order], np.arange(len(words) + 1)).tolist()
        flat = all_sym[order].tolist()
        return [flat[a:b] for a, b in zip(edges, edges[1:], strict=False)]

    def merge_queued(self, word: str) -> list[int]:
        """The same for one word, by a priority queue of pairs."""
        sym = [int(s) if s >= 0 else -ord(c) - 1 for c, s in ((c, self.char_ids[ord(c)]) for c in word)]
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        queue: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                piece = self.merges.get((sym[i], sym[j]))
                if piece is not None:
                    heapq.heappush(queue, (int(self.rank[piece]), i, sym[i], sym[j], piece))

        for i in range(n):
            offer(i)
        while queue:
            _, i, a, b, piece = heapq.heappop(queue)
            j = after[i] if alive[i] else n
            if j >= n or sym[i] != a or sym[j] != b:
                continue
            sym[i] = piece
            alive[j] = False
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [s for s, a in zip(sym, alive, strict=True) if a]

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Of each text: the number of its ids, the ids as comma-joined text, and the decoded text."""
        if len(self.known) > REMEMBERED_WORDS or len(self.numbers) > REMEMBERED_WORDS:
            self.forget()
        # Two spaces in a row belong to one word; such texts are cut as a whole.
        plain = [bool(t) and MARK not in t and "  " not in t and t[0] != " " != t[-1] for t in texts]
        number = self.numbers.__getitem__
        spaced = [list(map(number, t.split(" "))) if p else [] for t, p in zip(texts, plain, strict=True)]
        fresh = list(itertools.islice(self.numbers, len(self.spaced_ids), None))
        cut_fresh = [self.words.findall(MARK + w) for w in fresh]
        cut_whole = [
            self.words.findall(MARK + t.replace(" ", MARK)) if t else []
            for t, p in zip(texts, plain, strict=True)
            if not p
        ]
        self.learn(cut_fresh + cut_whole)
        for part, words in zip(fresh, cut_fresh, strict=True):
            ids, decoded = self._joined(words)
            if decoded != " " + part:
                self.odd[len(self.spaced_ids)] = decoded
            self.spaced_ids.append(ids)
        whole = map(self._joined, cut_whole)
        out = []
        for text, numbers, p in zip(texts, spaced, plain, strict=True):
            if p:
                ids, decoded = ",".join(map(self.spaced_ids.__getitem__, numbers)), " " + text
                if self.odd and not self.odd.keys().isdisjoint(numbers):
                    parts = zip(numbers, text.split(" "), strict=True)
                    decoded = "".join(self.odd.get(k, " " + part) for k, part in parts)
            else:
                ids, decoded = next(whole)
            out.append((ids.count(",") + 1 if ids else 0, ids, decoded.removeprefix(" ")))
        return out

    def _joined(self, words: list[str]) -> tuple[str, str]:
        found = list(map(self.known.__getitem__, words))
        return ",".join([f[0] for f in found]), "".join([f[1] for f in found])


def encode(docs: DataFrame, model: str, keep_texts: bool = False) -> DataFrame:
    """One row per document: n_tokens, ids_sha256, decoded_sha256 (and ids, decoded if ``keep_texts``)."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * keep_texts
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids string, decoded string" * keep_texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = PieceBpe(model)
        for batch in pieces(batches, "text", SLICE_BYTES):
            found = bpe.encode(batch.column("text").to_pylist())
            columns = [
                batch.column("doc_id"),
                pa.array([f[0] for f in found], pa.int64()),
                pa.array([hashlib.sha256(f[1].encode()).hexdigest() for f in found], pa.string()),
                pa.array([hashlib.sha256(f[2].encode()).hexdigest() for f in found], pa.string()),
            ]
            if keep_texts:
                columns += [pa.array([f[k] for f in found], pa.string()) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, schema)
