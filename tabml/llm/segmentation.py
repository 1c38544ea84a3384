"""SentencePiece encoding and decoding: k distinct segmentations of each text, sampled without replacement.

A text's lattice has an edge for every vocabulary piece (and a byte edge for characters without one).  Piece
probabilities follow the vocabulary's rank order (Zipf); the backward pass gives each position the mass of all ways to
the end, an exact bound for the search.

Gumbel top-k: every segmentation has a perturbed score, its log-probability plus a Gumbel variable; the k best are a
sample without replacement.  The search goes top down: the root's best score is drawn at once; following the drawn path,
all that branches off at a position is one open node whose best score is drawn from the Gumbel truncated at its
parent's.  The open node with the best score is the next sample: its branch is drawn, then the rest of the path, which
opens new nodes.  The best score left open after k samples is the threshold of the inclusion scores.

Pieces never cross the start of a word, so lattices are built once for each distinct word of a batch and walked for all
texts of the batch at a time with numpy.  All random numbers are hashes of (row key, sample, word, step): a text's
samples do not depend on partitions or repeated tasks, nor on batches but for the rounding of running sums.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm._common import col, empty_if_null

SPACE = "▁"
WORD = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
NO_CHAR = (1 << 21) - 1
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MOST = 54 * np.log(2) + 1  # above any Gumbel or -log(u) of ``uniform``


def spaced_words(text: str) -> str:
    """The text with spaces marked, and a space where no piece goes on: before each run of marks (and around line ends).

    Between single spaces a plain replacement does it; the line ends within are no part of any piece either way."""
    if text and text[0] != " " and "  " not in text and SPACE not in text:
        return SPACE + text.replace(" ", " " + SPACE)
    return " ".join(WORD.findall(SPACE + text.replace(" ", SPACE))) if text else ""


def split_words(text: str) -> list[str]:
    """The text's words, spaces marked: what ``spaced_words`` keeps apart."""
    return spaced_words(text).split(" ") if text else []


def coded_words(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words (UTF-8) of many texts by first place, the number of each occurrence's word, occurrences of each text."""
    spaced = [spaced_words(t) for t in texts]
    counts = np.array([t.count(" ") + 1 if t else 0 for t in spaced], np.int64)
    whole = pa.array([" ".join(filter(None, spaced)).encode("utf-8", "surrogatepass")] if counts.any() else [], pa.large_binary())
    found = pc.split_pattern(whole, " ").flatten().dictionary_encode()
    return found.dictionary, found.indices.to_numpy().astype(np.int64), counts


class Pieces:
    """Vocabulary of a model file: trie in a hash table (a node is its slot), log-probabilities, bytes of each id."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.bytes: list[bytes] = [b""] * n
        self.byte_id = np.zeros(256, np.int64)
        ranks = np.full(n, np.inf)
        children: dict[int, int] = {}
        at_node, nodes = {}, 1
        for k in range(n):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                self.byte_id[int(piece[3:5], 16)] = k
                self.bytes[k] = bytes([int(piece[3:5], 16)])
                continue
            if model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
                continue
            if SPACE in piece.lstrip(SPACE) or "\n" in piece:
                raise ValueError("pieces across words are not supported")
            ranks[k] = max(0.0, -model.get_score(k))
            self.bytes[k] = piece.replace(SPACE, " ").encode()
            node = 0
            for c in piece:
                key = node << 21 | ord(c)
                if key not in children:
                    children[key] = nodes
                    nodes += 1
                node = children[key]
            at_node[node] = k
        weight = np.where(np.isfinite(ranks), 1 / (ranks + 2.0), 0.0)
        with np.errstate(divide="ignore"):
            self.logp = np.log(weight / weight.sum())
        self.byte_logp = float(self.logp[np.isfinite(self.logp)].min() - np.log(2))
        self.size = np.array([len(x) for x in self.bytes], np.int64)
        self.offset = np.cumsum(self.size) - self.size
        self.blob = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.table = pa.array(self.bytes, pa.large_binary())
        bits = max(8, (4 * len(children)).bit_length())
        self.shift, self.mask, self.root = np.uint64(64 - bits), (1 << bits) - 1, 1 << bits
        self.keys = np.full(1 << bits, -1, np.int64)
        slot_of = np.full(nodes, self.root, np.int64)  # the nodes' slots, by the order in which they came
        parent, char = np.divmod(np.array(list(children), np.int64), 1 << 21)
        child = np.array(list(children.values()), np.int64)
        waiting = np.ones(len(child), bool)
        while waiting.any():  # a level at a time: a child's key holds its parent's slot
            level = np.flatnonzero(waiting & ~np.isin(parent, child[waiting]))
            self._place(slot_of, child[level], slot_of[parent[level]] << 21 | char[level])
            waiting[level] = False
        self.piece_at = np.full(self.root + 1, -1, np.int32)  # -1, no node, is the last entry like the root
        self.piece_at[slot_of[list(at_node)]] = list(at_node.values())

    def _place(self, slot_of: np.ndarray, nodes: np.ndarray, keys: np.ndarray) -> None:
        slot = ((keys.astype(np.uint64) * GOLDEN) >> self.shift).astype(np.int64)
        while len(keys):  # each free slot takes one key a round, the others try the next slot
            free = self.keys[slot] < 0
            first = np.unique(slot[free], return_index=True)[1]
            took = np.flatnonzero(free)[first]
            self.keys[slot[took]], slot_of[nodes[took]] = keys[took], slot[took]
            rest = np.ones(len(keys), bool)
            rest[took] = False
            keys, nodes, slot = keys[rest], nodes[rest], (slot[rest] + 1) & self.mask

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """Child nodes, -1 where there is none."""
        key = node << 21 | char
        slot = ((key.astype(np.uint64) * GOLDEN) >> self.shift).astype(np.int64)
        there = self.keys[slot]
        out = np.where(there == key, slot, -1)
        open_ = np.flatnonzero((there != key) & (there >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            there = self.keys[slot[open_]]
            hit = there == key[open_]
            out[open_[hit]] = slot[open_[hit]]
            open_ = open_[~hit & (there >= 0)]
        return out

    def ids(self, lattice: Lattice, edge: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
        """Ids of each path; a byte edge (piece -1) becomes the bytes of its character."""
        flat = lattice.piece[edge]
        as_bytes = np.flatnonzero(flat < 0)
        code = lattice.chars[lattice.source[edge[as_bytes]]]
        flat[as_bytes[code < 0x80]] = self.byte_id[code[code < 0x80]]
        out = np.split(flat, begin[1:-1])
        for t in np.unique(np.searchsorted(begin, as_bytes[code >= 0x80], side="right") - 1).tolist():
            a, b = begin[t], begin[t + 1]
            some = []
            for p, c in zip(flat[a:b].tolist(), lattice.chars[lattice.source[edge[a:b]]].tolist()):
                some += [p] if p >= 0 else self.byte_id[np.frombuffer(chr(c).encode("utf-8", "surrogatepass"), np.uint8)].tolist()
            out[t] = np.array(some, np.int64)
        return out

    def decoded(self, ids: Iterable[int]) -> bytes:
        """UTF-8 text of ids: the pieces' bytes one after the other, without the leading mark's space."""
        ids = np.asarray(ids, np.int64)
        size = self.size[ids]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ids) else 0) + np.repeat(self.offset[ids] - (ends - size), size)
        return self.blob[at].tobytes().removeprefix(b" ")

    def decode(self, ids: Iterable[int]) -> str:
        return self.decoded(ids).decode("utf-8", "replace")

    def decoded_rows(self, ids: pa.ListArray) -> pa.Array:
        """Texts of many rows of ids (null: null) by one gather; rows that are no UTF-8 are decoded one by one."""
        rows = pc.fill_null(pc.list_value_length(ids), 0).to_numpy().astype(np.int64)
        found = self.table.take(ids.flatten())
        ends = np.frombuffer(found.buffers()[1] or b"\0" * 8, np.int64, len(found) + 1)
        data = np.frombuffer(found.buffers()[2] or b"", np.uint8)
        at = ends[np.concatenate(([0], np.cumsum(rows)))]
        lead = np.zeros(len(data) + 1, bool)
        lead[at[:-1][np.diff(at) > 0]] = True
        lead[:-1] &= data == 32  # the leading mark's space
        at -= np.concatenate(([0], np.cumsum(lead)))[at]
        data = data[~lead[:-1]]
        texts = pa.LargeStringArray.from_buffers(len(rows), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data.tobytes()))
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            parts = np.split(data, at[1:-1])
            texts = pa.array([x.tobytes().decode("utf-8", "replace") for x in parts][: len(rows)], pa.large_string())
        return pc.if_else(ids.is_valid(), texts, pa.scalar(None, pa.large_string())).cast(pa.string())


_MODELS: dict[str, Pieces] = {}


def load_pieces(path: str) -> Pieces:
    """One vocabulary for each file and worker process."""
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


class Lattice:
    """Edges of many words at once, grouped by their start position; word w starts at ``start[w]``, ends at ``stop[w]``."""

    def __init__(self, words: pa.Array, pieces: Pieces) -> None:
        ends = np.concatenate(([0], np.cumsum(pc.binary_length(words).to_numpy())))
        text = words.buffers()[2].to_pybytes()[: ends[-1]] if len(words) else b""
        begins = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))  # characters before each byte
        sizes = np.diff(begins[ends])
        self.start = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))[: len(words)]
        self.stop = self.start + sizes
        total = int(sizes.sum()) + len(words)
        self.chars = np.full(total, NO_CHAR, np.int64)
        inside = np.ones(total, bool)
        inside[self.stop] = False
        self.chars[inside] = np.frombuffer(text.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
        layers, count = [], np.zeros(total, np.int32)
        at = np.flatnonzero(inside)
        node, depth = np.full(len(at), pieces.root), 0
        while len(at):
            node = pieces.step(node, self.chars[at + depth])
            piece = pieces.piece_at[node]
            full = np.flatnonzero(piece >= 0) if depth else np.arange(len(at))  # a character without a piece of its own has a byte edge
            source = at[full]
            place = count[source]
            layers.append((source, place, piece[full], depth + 1))
            count[source] = place + 1
            go = np.flatnonzero(node >= 0)
            at, node, depth = at[go], node[go], depth + 1
        self.degree = count
        self.first = np.cumsum(count, dtype=np.int64) - count
        self.last = self.first + count - 1
        n = int(count.sum())
        self.source = np.repeat(np.arange(total, dtype=np.int32), count)
        self.target, self.piece = np.empty(n, np.int32), np.empty(n, np.int32)
        for source, place, piece, size in layers:
            place = self.last[source] - place  # the longest piece first: it is the likeliest, so draws end early
            self.target[place], self.piece[place] = source + size, piece
        logp = pieces.logp[self.piece]
        as_bytes = np.flatnonzero(self.piece < 0)
        code = self.chars[self.source[as_bytes]]
        logp[as_bytes] = pieces.byte_logp * (1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000))
        mass = self._masses(logp, np.repeat(self.stop, sizes + 1) - np.arange(total))
        self.logq = np.minimum(0.0, logp + mass[self.target] - np.repeat(mass, count))
        self.q = np.exp(self.logq)
        run = np.concatenate(([0.0], np.cumsum(self.q)))
        self.cdf = run[1:] - np.repeat(run[self.first], count)
        self.cdf[self.last[count > 0]] = np.inf  # whatever rounding left, the last edge takes the rest

    def log_rest(self, edge: np.ndarray) -> np.ndarray:
        """Log-probability that an edge's position is left by another one."""
        with np.errstate(divide="ignore"):
            return np.where(self.degree[self.source[edge]] > 1, np.log(np.maximum(0.0, 1 - self.q[edge])), -np.inf)

    def _masses(self, logp: np.ndarray, to_stop: np.ndarray) -> np.ndarray:
        """Log-mass of all ways from each position to its word's end: positions at the same distance at a time."""
        mass = np.zeros(len(to_stop))
        order = np.argsort(to_stop.astype(np.uint16) if to_stop.max(initial=0) < 1 << 16 else to_stop, kind="stable")
        cuts = np.flatnonzero(np.diff(to_stop[order])) + 1
        for at in np.split(order, cuts)[1:]:  # the first are the ends
            edge, last = self.first[at], self.last[at]
            total, more = logp[edge] + mass[self.target[edge]], np.flatnonzero(edge < last)
            while len(more):
                edge[more] += 1
                e = edge[more]
                a, b = total[more], logp[e] + mass[self.target[e]]
                total[more] = np.maximum(a, b) + np.log1p(np.exp(-np.abs(a - b)))
                more = more[e < last[more]]
            mass[at] = total
        return mass

    def draw(self, position: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge from each position by its probability."""
        edge = self.first[position]
        open_ = np.flatnonzero(u >= self.cdf[edge])
        while len(open_):
            edge[open_] += 1
            open_ = open_[u[open_] >= self.cdf[edge[open_]]]
        return edge


def mixed(key: np.ndarray, *parts: np.ndarray | int) -> np.ndarray:
    """Hash of (key, parts), to be mixed further."""
    x = key.astype(np.uint64)
    with np.errstate(over="ignore"):
        for p in parts:
            x = (x ^ np.asarray(p, np.uint64)) * GOLDEN
            x ^= x >> np.uint64(32)
    return x


def uniform(key: np.ndarray, *parts: np.ndarray | int) -> np.ndarray:
    """Hash of (key, parts) in (0, 1)."""
    x = mixed(key, *parts)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def truncated_gumbel(location: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel at ``location``, conditioned on being below ``top``; -inf where the location is."""
    with np.errstate(divide="ignore", invalid="ignore"):
        out = location - np.log(np.exp(np.minimum(700.0, location - top)) - np.log(u))
    return np.where(np.isneginf(location), -np.inf, np.minimum(out, top))


@dataclass
class Paths:
    """One path per text (or none): flat arrays sorted by text, word and step."""

    word: np.ndarray  # occurrence index in the batch
    edge: np.ndarray
    step: np.ndarray
    begin: np.ndarray  # of each text, plus the end
    before: np.ndarray  # log-probability of the path before each step
    open: np.ndarray  # best perturbed score of what branches off at each step


class Search:
    """Gumbel top-k over a batch of texts."""

    def __init__(self, texts: list[str], keys: np.ndarray, pieces: Pieces) -> None:
        known, word, counts = coded_words(texts)
        self.keys = keys
        self.lattice = Lattice(known, pieces)
        self.text = np.repeat(np.arange(len(texts)), counts)  # of each occurrence
        self.start, self.stop = self.lattice.start[word], self.lattice.stop[word]
        self.begin = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
        self.nth = np.arange(len(word)) - self.begin[self.text] if len(word) else word

    def walk(self, sample: int, word: np.ndarray, position: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Draw from each (occurrence, position) to the end of its word: (occurrence, step, edge)."""
        out = []
        go = position < self.stop[word]
        word, position, step = word[go], position[go], step[go]
        key, stop = mixed(self.keys[self.text[word]], 2 * sample, self.nth[word]), self.stop[word]
        while len(word):
            edge = self.lattice.draw(position, uniform(key, step))
            out.append((word, step, edge))
            position, step = self.lattice.target[edge], step + 1
            go = np.flatnonzero(position < stop)
            word, position, step, key, stop = word[go], position[go], step[go], key[go], stop[go]
        empty = np.zeros(0, np.int64)
        return tuple(map(np.concatenate, zip(*out))) if out else (empty, empty, empty)

    def paths(self, word: np.ndarray, step: np.ndarray, edge: np.ndarray) -> Paths:
        """Put steps in order; nothing is open yet."""
        per_word = np.bincount(word, minlength=len(self.text))
        base = np.concatenate(([0], np.cumsum(per_word)))
        place = base[word] + step
        order = np.empty(len(word), np.int64)
        order[place] = np.arange(len(word))
        word, step, edge = word[order], step[order], edge[order]
        begin = base[self.begin]
        run = np.concatenate(([0.0], np.cumsum(self.lattice.logq[edge])))
        before = run[:-1] - np.repeat(run[begin[:-1]], np.diff(begin))
        return Paths(word, edge, step, begin, before, np.full(len(word), -np.inf))

    def open_nodes(self, p: Paths, top: np.ndarray, sample: int, after: np.ndarray, k: int) -> None:
        """Draw the best score of each branch of a path whose own score is ``top``, for steps after ``after``.

        Random numbers lie in (2^-54, 1 - 2^-54), so a Gumbel is below ``MOST`` and a branch at ``x`` scores at least
        x - log(exp(x - top) + MOST).  What cannot be among the k + 1 best by these bounds is never asked for and stays
        undrawn; as the prefix mass only falls, that is all but the beginning of a long text.
        """
        n = len(self.keys)
        length = np.diff(p.begin)
        skip = np.minimum(np.maximum(after + 1, 0), length)
        head = skip[:, None] + np.arange(32)[None, :]
        at = np.minimum(p.begin[:-1, None] + head, max(0, len(p.edge) - 1))
        if not len(p.edge):
            return
        rest = np.where(head < length[:, None], p.before[at] + self.lattice.log_rest(p.edge[at]), -np.inf)
        known = np.partition(rest, 31 - k, axis=1)[:, 31 - k] if k < 32 else np.full(n, -np.inf)
        gap = np.where(np.isneginf(known), 0.0, known) - np.where(np.isneginf(top), 0.0, top)
        floor = known - np.logaddexp(gap, np.log(MOST)) - MOST
        text = self.text[p.word]
        live = np.flatnonzero((p.before >= floor[text]) & (np.arange(len(p.edge)) - p.begin[text] > after[text]))
        word, edge, text = p.word[live], p.edge[live], text[live]
        u = uniform(self.keys[text], 2 * sample + 1, self.nth[word], p.step[live])
        p.open[live] = truncated_gumbel(p.before[live] + self.lattice.log_rest(edge), top[text], u)

    def run(self, k: int) -> Iterator[tuple[np.ndarray, Paths, np.ndarray, np.ndarray, np.ndarray]]:
        """For each of up to k samples: (texts that have it, paths, log-probability, score, threshold after k samples)."""
        n, lat = len(self.keys), self.lattice
        every = np.arange(len(self.text))
        first = self.paths(*self.walk(0, every, self.start.copy(), np.zeros(len(every), np.int64)))
        top = -np.log(-np.log(uniform(self.keys, 0)))
        self.open_nodes(first, top, 0, np.full(n, -1), k)
        found, held = [(np.ones(n, bool), first, top)], [first]
        taken: dict[tuple[int, int, int], list[int]] = {}  # edges drawn at a node beside the path's own
        for sample in range(1, k + 1):
            best, which, where = np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for s, p in enumerate(held):
                some = np.flatnonzero(np.diff(p.begin) > 0)
                if not len(some):
                    continue
                most = np.maximum.reduceat(p.open, p.begin[some]) if len(p.open) else np.zeros(0)
                at = np.flatnonzero(p.open == np.repeat(most, np.diff(p.begin)[some]))
                t, i = np.unique(self.text[p.word[at]], return_index=True)
                better = p.open[at[i]] > best[t]
                t, at = t[better], at[i][better]
                best[t], which[t], where[t] = p.open[at], s, at
            if sample == k:
                break
            there = np.isfinite(best)
            new: list[tuple[int, int, int]] = []
            prefix = []
            after = np.full(n, 1 << 60)
            for s, p in enumerate(held):
                mine = np.flatnonzero(there & (which == s))
                if not len(mine):
                    continue
                cut = np.full(n, -1)
                cut[mine] = where[mine]
                keep = np.arange(len(p.edge)) < cut[self.text[p.word]]
                prefix.append((p.word[keep], p.step[keep], p.edge[keep]))
                after[mine] = where[mine] - p.begin[mine]
                u = uniform(self.keys[mine], 2 * sample, np.full(len(mine), 1 << 40), 0)
                u2 = uniform(self.keys[mine], 2 * sample, np.full(len(mine), 1 << 41), 0)
                for t, at, x, y in zip(mine.tolist(), where[mine].tolist(), u.tolist(), u2.tolist()):
                    gone = taken.setdefault((s, t, at), [int(p.edge[at])])
                    here = lat.source[p.edge[at]]
                    rest = [e for e in range(int(lat.first[here]), int(lat.last[here]) + 1) if e not in gone]
                    share = np.cumsum(lat.q[rest])
                    e = rest[min(int(np.searchsorted(share, x * share[-1], side="right")), len(rest) - 1)]
                    gone.append(e)
                    new.append((int(p.word[at]), int(p.step[at]), e))
                    left = float(sum(lat.q[r] for r in rest if r != e))
                    mass = np.array([p.before[at] + np.log(left) if left > 0 else -np.inf])
                    p.open[at] = truncated_gumbel(mass, best[t : t + 1], np.array([y]))[0]
            if not new:
                break
            w, st, e = (np.array(c, np.int64) for c in zip(*new))
            turned = np.full(n, 1 << 60)
            turned[self.text[w]] = w
            later = np.flatnonzero(every > turned[self.text])
            zero = np.zeros(len(later), np.int64)
            fresh = self.walk(sample, np.concatenate((w, later)), np.concatenate((lat.target[e], self.start[later])), np.concatenate((st + 1, zero)))
            parts = [*prefix, (w, st, e), fresh]
            p = self.paths(*(np.concatenate(c) for c in zip(*parts)))
            self.open_nodes(p, best, sample, after, k)
            held.append(p)
            found.append((there, p, best))
        threshold = best
        for there, p, score in found:
            run = np.concatenate(([0.0], np.cumsum(lat.logq[p.edge])))
            yield there, p, run[p.begin[1:]] - run[p.begin[:-1]], score, threshold


def sample_texts(texts: list[str], keys: np.ndarray, pieces: Pieces, k: int) -> Iterator[tuple[int, int, np.ndarray, float, float, float]]:
    """(text, sample, ids, log_prob, score, log_inclusion) for a batch of texts."""
    search = Search(texts, keys, pieces)
    lat = search.lattice
    for sample, (there, p, logp, score, threshold) in enumerate(search.run(k)):
        gap = logp - threshold
        # log(1 - exp(-exp(gap))); far below the threshold it is the gap itself
        near = np.log(-np.expm1(-np.exp(np.clip(gap, -30, 700))))
        inclusion = np.where(gap < -30, gap, near)
        ids = pieces.ids(lat, p.edge, p.begin)
        for t in np.flatnonzero(there).tolist():
            yield t, sample, ids[t], float(logp[t]), float(score[t]), float(inclusion[t])


def _grouped(batches: Iterable[pa.RecordBatch], max_chars: int) -> Iterator[pa.RecordBatch]:
    """Slices of about ``max_chars`` characters; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.utf8_length(batch.column("text")).to_numpy()
        at = 0
        while at < len(sizes):
            n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), max_chars, side="right")))
            yield batch.slice(at, n)
            at += n


SCHEMA = "doc_id bigint, sample int, n_ids bigint, ids_crc32 bigint, log_prob double, score double, log_inclusion double, round_trip boolean, ids array<int>"


def _columns(part: pa.RecordBatch, rows: list[tuple], pieces: Pieces, with_ids: bool) -> list[pa.Array]:
    """The columns of ``SCHEMA`` for samples of a batch; their ids are decoded together."""
    at, sample, found, *scores = zip(*rows)
    size = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.concatenate(([0], np.cumsum(size)))
    flat = np.concatenate(found).astype("<i4")
    crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
    same = pc.equal(pieces.decoded_rows(ids), part.column("text").take(pa.array(at)).cast(pa.string()))
    numbers = [pa.array(c, pa.float64()) for c in scores]
    return [part.column("id").take(pa.array(at)), pa.array(sample, pa.int32()), pa.array(size), pa.array(crc, pa.int64()), *numbers, same, ids if with_ids else pa.nulls(len(rows), pa.list_(pa.int32()))]


def sample_segmentations(df: DataFrame, model_path: str, k: int = 2, id_col: str = "doc_id", text_col: str = "text", seed: int = 0, with_ids: bool = True, max_chars: int = 1_000_000) -> DataFrame:
    """Up to ``k`` rows per row of ``df``: distinct segmentations of its whole text, sampled without replacement.

    ``sample`` counts from 0 by falling ``score`` (the perturbed log-probability); ``log_prob`` is the segmentation's
    log-probability given the text; ``log_inclusion`` the log of the probability that its score passes the threshold,
    the best score left out.  ``round_trip`` tells whether the ids decode to the text: not where it has U+2581, which the vocabulary
    takes for a space.  A text with fewer segmentations
    has fewer rows; a null or empty text has one, without ids.  Of equal scores the first found stays.  A text longer than
    ``max_chars`` is one lattice by itself, so memory follows the longest text.  The row key is the id (null: none) and ``seed``, so
    rows repeated whole get the same samples; other columns are not looked at; an empty table gives no row.
    """

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(model_path)
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        for part in _grouped(batches, max_chars):
            texts, rows = part.column("text").to_pylist(), []
            keys = part.column("key").to_numpy().view(np.uint64)
            for row in sample_texts(texts, keys, pieces, k):
                rows.append(row)
                if len(rows) >= 2000:
                    yield pa.RecordBatch.from_arrays(_columns(part, rows, pieces, with_ids), names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays(_columns(part, rows, pieces, with_ids), names=names)

    rows = df.select(col(id_col).cast("bigint").alias("id"), F.xxhash64(F.lit(seed), col(id_col).cast("bigint")).alias("key"), empty_if_null(col(text_col)).alias("text"))
    found = rows.mapInArrow(search, SCHEMA)
    return found if id_col == "doc_id" else found.withColumnRenamed("doc_id", id_col)


def decode_ids(df: DataFrame, model_path: str, ids_col: str = "ids", to: str = "text") -> DataFrame:
    """All rows of ``df`` with the text of their ids added as ``to``; null ids decode to null."""
    @F.arrow_udf("string")
    def decoded(ids: pa.Array) -> pa.Array:
        return load_pieces(model_path).decoded_rows(ids)

    return df.withColumn(to, decoded(col(ids_col).cast("array<int>")))
