"""Sampled subword segmentation over the lattice of pieces, and lossless decoding.

Every text is cut where no piece crosses: before blanks, around line feeds, and between a letter and a sign after it. A chunk's
lattice has a state per position, with an edge for each piece that ends there; a character without a piece is spelled in
bytes. Forward filtering adds up the weight of all ways to a position, once per distinct chunk. Backward sampling then draws
the last piece of a chunk by its share, and so on to the chunk's start; all chunks of a batch take a step together. So a
segmentation is drawn with the probability of its weight among all segmentations of the text.

The random numbers are hashes of row key, chunk and step: a row is segmented alike in any partition, attempt or company.
A piece of rank r in the vocabulary has weight 1 / (r + RANK_SHIFT) (the vocabulary file has ranks, no frequencies), raised
to the power `sharpness`: 0 draws all segmentations alike, large values the most likely one.

Decoding joins the pieces' bytes, so it gives back every text: blanks are the pieces' mark, and the mark as a character is
spelled in bytes.

Defined results: a NULL or empty text has no ids and decodes to an empty text. Rows that share key and text are segmented
alike; a NULL key counts as 0. Other columns are kept. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "▁"  # Fixed values: the vocabulary's sign for a blank, and a character that is in no piece.
NO_PIECE = "\x00"
RANK_SHIFT = 10.0
_GOLD, _M1, _M2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _uniform(x: np.ndarray) -> np.ndarray:
    """Hashed numbers in [0, 1)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
    # 24 bits: added to the number of a state they still leave it below the next one.
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(40)).astype(np.float64) / (1 << 24)


class Vocabulary:
    """Pieces of a SentencePiece model file, with bytes to spell what they lack."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.as_bytes: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.as_bytes.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.as_bytes.append(b"")
            else:
                self.pieces[piece] = i
                self.as_bytes.append(piece.replace(MARK, " ").encode())
        self._build_tree()
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("a piece crosses a blank")
        signs = [c for c in ".,;:!?" if not any(re.search(rf"[^\W\d_]\{c}", p) for p in self.pieces)]
        word = rf" *[^\W\d_]+(?=[{re.escape(''.join(signs))}])|" if signs else ""
        long_pieces = "".join(p for p in self.pieces if len(p) > 1)
        self.chunk = re.compile(word + (" *[^ ]+| +" if "\n" in long_pieces else r"\n| *[^ \n]+| +"))

    def _build_tree(self) -> None:
        """The tree of the pieces' characters: sorted (node, character) keys with the node they lead to, and each node's
        piece, -1 where none ends."""
        characters = sorted({c for p in self.pieces for c in p})
        self.number = np.full(0x110000, -1, np.int64)
        self.number[[ord(c) for c in characters]] = np.arange(len(characters))
        nodes, steps = {"": 0}, {}
        for piece in self.pieces:
            for n in range(1, len(piece) + 1):
                if piece[:n] not in nodes:
                    nodes[piece[:n]] = len(nodes)
                    steps[nodes[piece[: n - 1]] * len(characters) + int(self.number[ord(piece[n - 1])])] = nodes[piece[:n]]
        self.n_characters = len(characters)
        self.step_keys = np.array(sorted(steps), np.int64)
        self.step_to = np.array([steps[k] for k in self.step_keys.tolist()], np.int64)
        self.node_piece = np.array([self.pieces.get(p, -1) for p in nodes], np.int64)

    def matches(self, text: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first place, last place, piece) of every piece in the text that stays before its first place's end."""
        codes = self.number[np.frombuffer(text.encode("utf-32-le"), "<u4")]
        at, node, found = np.arange(len(codes)), np.zeros(len(codes), np.int64), []
        depth = 0
        while len(at):
            inside = at + depth < ends[at]
            at, node = at[inside], node[inside]
            code = codes[at + depth]
            key = node * self.n_characters + code
            place = np.minimum(np.searchsorted(self.step_keys, key), len(self.step_keys) - 1)
            there = (code >= 0) & (self.step_keys[place] == key)
            at, node = at[there], self.step_to[place[there]]
            piece = self.node_piece[node]
            ending = piece >= 0
            found.append((at[ending], at[ending] + depth, piece[ending]))
            depth += 1
        first, last, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        return first, last, piece


class Growing:
    """An array that is appended to."""

    def __init__(self, kind: type):
        self.held, self.n = np.zeros(1 << 12, kind), 0

    def extend(self, values) -> None:
        need = self.n + len(values)
        if need > len(self.held):
            self.held = np.concatenate([self.held[: self.n], np.zeros(max(need, self.n * 3 // 2) - self.n, self.held.dtype)])
        self.held[self.n : need] = values
        self.n = need

    @property
    def all(self) -> np.ndarray:
        return self.held[: self.n]


class Sampler:
    """Draws segmentations; keeps the filtered lattices of chunks that come again, up to a number of edges."""

    def __init__(self, path: str, sharpness: float = 1.0, max_edges: int = 3_000_000):
        self.vocabulary = Vocabulary(path)
        self.max_edges = max_edges
        pieces = sorted(self.vocabulary.pieces.values())
        self.weight = np.full(len(self.vocabulary.as_bytes), -np.inf)
        self.weight[pieces] = -sharpness * np.log(np.arange(len(pieces)) + RANK_SHIFT)
        self.byte_weight = -sharpness * log(len(pieces) + RANK_SHIFT)
        self._clear()

    def _clear(self) -> None:
        self.ends: dict[str, int] = {}  # chunk -> its last state
        self.states = 0
        self.met = np.zeros(1 << 24, bool)  # hashes of chunks met in an earlier batch
        # Per edge: state + cumulative share, the state before it (-1: the chunk's start), and its way of spelling.
        self.key, self.before, self.spelling = Growing(np.float64), Growing(np.int32), Growing(np.int32)
        self.begin = Growing(np.int64)  # first edge of every state
        # Spellings: a piece is its own id; characters without a piece follow, as their bytes.
        n = len(self.weight)
        self.spelled: dict[str, int] = {}
        self.first, self.count, self.ids = (Growing(k) for k in (np.int64, np.int64, np.uint32))
        self.first.extend(range(n))
        self.count.extend([1] * n)
        self.ids.extend(range(n))

    def _spell(self, character: str) -> int:
        if character not in self.spelled:
            own = [self.vocabulary.byte_ids[b] for b in character.encode()]
            self.spelled[character] = self.first.n
            self.first.extend([self.ids.n])
            self.count.extend([len(own)])
            self.ids.extend(own)
        return self.spelled[character]

    def _learn(self, chunks: list[str]) -> None:
        if not chunks:
            return
        base, lengths = self.states, np.array([len(c) for c in chunks], np.int64)
        stops = np.cumsum(lengths)
        text = "".join(chunks)
        ends = np.repeat(stops, lengths)
        first, last, spelling = self.vocabulary.matches(text.replace(MARK, NO_PIECE).replace(" ", MARK), ends)
        alone = np.ones(len(text), bool)
        alone[first[first == last]] = False
        alone = np.flatnonzero(alone)
        spelled = np.array([self._spell(text[i]) for i in alone.tolist()], np.int64)
        first, last, spelling = (np.concatenate(x) for x in ((first, alone), (last, alone), (spelling, spelled)))
        order = np.lexsort((first, last))
        first, state, spelling = first[order], last[order], spelling[order]
        before = np.where(first == ends[first] - np.repeat(lengths, lengths)[first], -1, first - 1)
        self.ends.update(zip(chunks, (base + stops - 1).tolist(), strict=True))
        self.states = base + len(text)
        counts = self.count.all[spelling]
        weight = np.where(spelling < len(self.weight), self.weight[np.minimum(spelling, len(self.weight) - 1)], counts * self.byte_weight)
        self.begin.extend(self.key.n + np.searchsorted(state, np.arange(len(text))))
        self.key.extend(base + state + self._shares(before, state, weight, lengths))
        self.before.extend(np.where(before < 0, -1, before + base))
        self.spelling.extend(spelling)

    @staticmethod
    def _shares(before: np.ndarray, state: np.ndarray, weight: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Cumulative share of each edge among those that end in its state; edges are sorted by state.

        Forward filtering, for all chunks at once: first the states one character in, then two, and so on.
        """
        depth = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ways, share = np.zeros(len(depth) + 1), np.empty(len(state))  # the last entry stands for a chunk's start
        by_depth = np.argsort(depth[state], kind="stable")
        levels = np.searchsorted(depth[state][by_depth], np.arange(int(sizes.max()) + 1))
        for a, b in zip(levels[:-1].tolist(), levels[1:].tolist(), strict=True):
            edges = by_depth[a:b]
            to = state[edges]
            value = weight[edges] + ways[before[edges]]
            new = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            group = np.cumsum(np.concatenate([[0], to[1:] != to[:-1]]))
            top = np.maximum.reduceat(value, new)
            part = np.exp(value - top[group])
            total = np.add.reduceat(part, new)
            ways[to[new]] = top + np.log(total)
            share[edges] = part / total[group]
        sums = np.cumsum(share)
        last = np.concatenate([state[1:] != state[:-1], [True]])
        ends = np.flatnonzero(last)
        cumulative = sums - np.concatenate([[0.0], sums[ends[:-1]]])[np.cumsum(last) - last]
        cumulative[ends] = 1.0
        return cumulative

    def encode(self, keys: list[int | None], texts: list[str | None]) -> list[np.ndarray]:
        """The sampled ids of every text."""
        cut = [self.vocabulary.chunk.findall(f" {t}") if t else [] for t in texts]
        every = set().union(*cut)
        new = every.difference(self.ends)
        if new and self.key.n > self.max_edges:
            self._clear()
            new = every
        # Chunks met before are learned for good, others for this batch.
        again = [c for c in new if self.met[hash(c) & 0xFFFFFF]]
        once = list(new.difference(again))
        self._learn(again)
        keep = [g.n for g in (self.begin, self.key, self.before, self.spelling)]
        self._learn(once)
        counts = np.array([len(c) for c in cut], np.int64)
        n = int(counts.sum())
        state = np.fromiter((self.ends[c] for some in cut for c in some), np.int64, n)
        number = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
        seeds = np.array([(k or 0) % (1 << 64) for k in keys], np.uint64)
        with np.errstate(over="ignore"):
            seed = (np.repeat(seeds, counts) * _M2 + number.astype(np.uint64) + np.uint64(1)) * _GOLD
        chunk, steps, drawn = np.arange(n), np.zeros(n, np.int64), []
        key, before, begin = self.key.all, self.before.all, self.begin.all
        while len(chunk):
            with np.errstate(over="ignore"):
                u = _uniform(seed[chunk] + np.uint64(len(drawn) + 1) * _M1)
            # The first edge of the state whose cumulative share is above the random number.
            edge, goal = begin[state], state + u
            below = np.flatnonzero(key[edge] <= goal)
            while len(below):
                edge[below] += 1
                below = below[key[edge[below]] <= goal[below]]
            drawn.append((chunk, edge))
            steps[chunk] += 1
            state = before[edge]
            chunk, state = chunk[state >= 0], state[state >= 0]
        # Steps run backwards: the last draw of a chunk is its first piece.
        ends = np.cumsum(steps)
        edges = np.empty(int(ends[-1]) if n else 0, np.int64)
        for t, (chunk, edge) in enumerate(drawn):
            edges[ends[chunk] - 1 - t] = edge
        spelling = self.spelling.all[edges]
        sizes = self.count.all[spelling]
        stops = np.cumsum(sizes)
        spread = np.arange(int(stops[-1]) if len(stops) else 0) - np.repeat(stops - sizes, sizes)
        ids = self.ids.all[np.repeat(self.first.all[spelling], sizes) + spread]
        pieces_to = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        at = np.concatenate([[0], stops])[pieces_to]
        out = [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        for chunk in once:
            self.met[hash(chunk) & 0xFFFFFF] = True
            del self.ends[chunk]
        self.states = keep[0]
        for g, n in zip((self.begin, self.key, self.before, self.spelling), keep, strict=True):
            g.n = n
        return out

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.vocabulary.as_bytes.__getitem__, ids.tolist())).decode()[1:]


@lru_cache(maxsize=2)
def _sampler(path: str, sharpness: float) -> Sampler:
    return Sampler(path, sharpness)


def _some(texts: list, most: int = 1 << 19) -> Iterator[slice]:
    """Slices of about `most` characters."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= most:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def sampled_ids(key: Column, text: Column, model: str, sharpness: float = 1.0) -> Column:
    """Column (ids binary, lossless boolean) of `text`: the sampled ids as little-endian unsigned 32-bit integers, and
    whether they decode to the text. `model` is a path in every task."""

    @F.pandas_udf("ids binary, lossless boolean")
    def encode(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        sampler = _sampler(model, sharpness)
        for keys, texts in batches:
            keys, texts, out = keys.tolist(), texts.tolist(), []
            for part in _some(texts):
                found = sampler.encode(keys[part], texts[part])
                for ids, own in zip(found, texts[part], strict=True):
                    out.append((ids.astype("<u4", copy=False).tobytes(), sampler.decode(ids) == (own or "")))
            yield pd.DataFrame(out, columns=["ids", "lossless"])

    return encode(F.coalesce(key.cast("long"), F.lit(0)), text)


def decoded(ids: Column, model: str) -> Column:
    """Column of the texts of ids as `sampled_ids` gives them, whatever the segmentation."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sampler = _sampler(model, 1.0)
        for some in batches:
            yield pd.Series([sampler.decode(np.frombuffer(x or b"", "<u4")) for x in some], dtype=object)

    return decode(ids)
