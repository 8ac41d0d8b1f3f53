"""Token counts under a unigram model, by dynamic programming shared along a trie.

The pieces are those of a public vocabulary file, which has no probabilities;
they are fitted to the documents by expectation-maximisation.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, checkpointed, shuffle_partitions

#: What stands for the blank before a word.
BLANK = "▁"
#: Code points of words whose trie is made together, and words with their counts that a worker holds; then it starts afresh. Counts don't depend on it.
NODES, WORDS = 400_000, 400_000


@dataclass(frozen=True)
class Vocabulary:
    """Log probabilities of pieces; ``unknown`` is that of each byte of a character without a piece."""

    logs: dict[str, float]
    unknown: float

    @property
    def longest(self) -> int:
        return max(map(len, self.logs), default=1)

    @staticmethod
    def ranked(pieces: list[str]) -> Vocabulary:
        """Pieces in order of falling frequency under Zipf's law: p proportional to 1 / rank."""
        total = math.log(sum(1 / r for r in range(1, len(pieces) + 1)) or 1.0)
        logs = {x: -math.log(r) - total for r, x in enumerate(pieces, 1)}
        return Vocabulary(logs, min(logs.values(), default=0.0) - 10.0)

    @staticmethod
    def of_file(path: str | None = None) -> Vocabulary:
        """The ordinary pieces of a public sentencepiece model, in the file's order of rank."""
        import sentencepiece

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("piece_bpe_32k.model")
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        special = lambda k: sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k) or sp.is_unused(k)
        return Vocabulary.ranked([sp.id_to_piece(k) for k in range(sp.get_piece_size()) if not special(k)])

    def fitted(self, words: dict[str, int], rounds: int = 4, prior: float = 1_000.0) -> Vocabulary:
        """The same pieces with the log probabilities that expectation-maximisation gives them on words and their counts.

        Present probabilities count as ``prior`` pieces seen before, so none gets
        to zero. The words' order doesn't matter; without words nothing changes.
        """
        words = {w: words[w] for w in sorted(words) if w}

        def expected(now: dict[str, float]) -> dict[str, float]:
            seen: dict[str, float] = {}
            for word, n in words.items():
                _expect(word, n, now, math.exp(self.unknown), self.longest, seen)
            return seen

        return self.maximised(expected, rounds, prior) if words else self

    def maximised(self, expected: Callable[[dict[str, float]], dict[str, float]], rounds: int = 4, prior: float = 1_000.0) -> Vocabulary:
        """The pieces after some rounds in which ``expected`` tells how often each comes under the present probabilities."""
        if not self.logs:
            return self
        before = {x: math.exp(log) for x, log in self.logs.items()}
        now = dict(before)
        for _ in range(rounds):
            seen = expected(now)
            total = prior + sum(seen.values())
            now = {x: (seen.get(x, 0.0) + prior * before[x]) / total for x in now}
        logs = {x: math.log(p) for x, p in now.items()}
        return Vocabulary(logs, min(logs.values()) - 10.0)


def _expect(word: str, n: int, p: dict[str, float], floor: float, longest: int, seen: dict[str, float]) -> None:
    """Adds how often each piece is expected in ``n`` times the word, by forward and backward sums over its splits."""
    size = len(word)
    edges = []  # (start, stop, piece or None, probability)
    for start in range(size):
        for stop in range(start + 1, min(size, start + longest) + 1):
            piece = word[start:stop]
            if (chance := p.get(piece)) is not None:
                edges.append((start, stop, piece, chance))
            elif stop == start + 1:
                edges.append((start, stop, None, floor ** len(piece.encode("utf-8", "surrogatepass"))))
    ahead, behind = [0.0] * (size + 1), [0.0] * (size + 1)
    ahead[0] = behind[size] = 1.0
    for start, stop, _, chance in edges:
        ahead[stop] += ahead[start] * chance
    if ahead[size] < 1e-200:
        _expect_by_logs(size, edges, n, seen)  # too unlikely for a double
        return
    for start, stop, _, chance in reversed(edges):
        behind[start] += behind[stop] * chance
    for start, stop, piece, chance in edges:
        if piece is not None:
            seen[piece] = seen.get(piece, 0.0) + n * ahead[start] * chance * behind[stop] / ahead[size]


def _expect_by_logs(size: int, edges: list[tuple], n: int, seen: dict[str, float]) -> None:
    """The same sums as logarithms, for words of any length."""
    add = lambda x, y: max(x, y) + math.log1p(math.exp(-abs(x - y))) if min(x, y) > -math.inf else max(x, y)
    ahead, behind = [-math.inf] * (size + 1), [-math.inf] * (size + 1)
    ahead[0] = behind[size] = 0.0
    steps = [(start, stop, piece, math.log(chance)) for start, stop, piece, chance in edges if chance > 0]
    for start, stop, _, log in steps:
        ahead[stop] = add(ahead[stop], ahead[start] + log)
    for start, stop, _, log in reversed(steps):
        behind[start] = add(behind[start], behind[stop] + log)
    for start, stop, piece, log in steps:
        if piece is not None:
            seen[piece] = seen.get(piece, 0.0) + n * math.exp(ahead[start] + log + behind[stop] - ahead[size])


#: Words whose sums are taken together, and the length from which on a word is summed up alone.
_TOGETHER, _LONG = 2_000, 64
#: Words at most whose trie is made together.
_SOME = 20_000
_PAD = 0xFFFFFFFF
_U = np.uint64
_BASE, _SHIFT = _U(0x9E3779B97F4A7C15), _U(44)


def _code_points(words: list[str], width: int) -> np.ndarray:
    """One column a word, filled up."""
    rows = np.full((len(words), width), _PAD, np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    rows[np.arange(width) < sizes[:, None]] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.ascontiguousarray(rows.T)


class Lattice:
    """What ``_expect`` adds up, for many words at a time: windows of code points are looked up by hash among the pieces of their length, then compared."""

    def __init__(self, pieces: list[str], floor: float):
        self.pieces, self.floor = pieces, floor
        self.longest = max(map(len, pieces), default=1)
        self.by_length: dict[int, tuple[np.ndarray, ...]] = {}
        for size in sorted({len(x) for x in pieces if x}):
            at = np.array([k for k, x in enumerate(pieces) if len(x) == size])
            codes = _code_points([pieces[k] for k in at], size)
            h = np.zeros(len(at), np.uint64)
            for c in codes:
                h = h * _BASE + c + np.uint64(1)
            order = np.argsort(h, kind="stable")
            marks = np.zeros(1 << 20, bool)
            marks[h * _BASE >> _SHIFT] = True
            self.by_length[size] = h[order], at[order], np.ascontiguousarray(codes[:, order]), marks

    def _windows(self, codes: np.ndarray, p: np.ndarray) -> dict[int, tuple[np.ndarray, tuple[np.ndarray, np.ndarray], np.ndarray]]:
        """By size of window: its probability, and where (start, word) it is which piece."""
        h = np.zeros(codes.shape, np.uint64)
        out = {}
        for size in range(1, min(self.longest, len(codes)) + 1):
            h = h[: len(codes) - size + 1] * _BASE + codes[size - 1 :] + np.uint64(1)
            chance = np.zeros(h.shape)
            if size == 1:
                powers = np.array([self.floor**k for k in range(5)])
                chance = np.where(codes == _PAD, 0.0, powers[1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)])
            elif size not in self.by_length:
                continue
            start, word, ids = (np.zeros(0, np.int64),) * 3
            if size in self.by_length:
                hashes, at, known, seen = self.by_length[size]
                start, word = np.nonzero(seen[h * _BASE >> _SHIFT])  # most windows are no piece
                mine = h[start, word]
                place = np.minimum(np.searchsorted(hashes, mine), len(hashes) - 1)
                same = hashes[place] == mine
                for k in range(size):
                    same &= codes[start + k, word] == known[k, place]
                start, word, ids = start[same], word[same], at[place[same]]
                chance[start, word] = p[ids]
            if size == 1 or len(ids):
                out[size] = chance, (start, word), ids
        return out

    def expect(self, words: list[str], n: np.ndarray, p: np.ndarray, seen: np.ndarray) -> None:
        """Adds to ``seen`` how often each piece is expected in the words, each ``n`` times, under the probabilities ``p``."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        alone = order[sizes[order] > _LONG].tolist()
        order = order[: len(order) - len(alone)]
        for start in range(0, len(order), _TOGETHER):
            alone += self._expect_together(order[start : start + _TOGETHER], words, sizes, n, p, seen)
        if not alone:
            return
        place = {x: k for k, x in enumerate(self.pieces)}
        now, found = dict(zip(self.pieces, p.tolist(), strict=True)), {}
        for k in alone:
            _expect(words[k], int(n[k]), now, self.floor, self.longest, found)
        for piece, x in found.items():
            seen[place[piece]] += x

    def _expect_together(self, rows: np.ndarray, words: list[str], sizes: np.ndarray, n: np.ndarray, p: np.ndarray, seen: np.ndarray) -> list[int]:
        """Returns the words that are too unlikely for a double."""
        sizes, width, each = sizes[rows], int(sizes[rows[-1]]), np.arange(len(rows))
        windows = self._windows(_code_points([words[k] for k in rows], width), p)
        ahead, behind = np.zeros((width + 1, len(rows))), np.zeros((width + 1, len(rows)))
        ahead[0] = behind[sizes, each] = 1.0
        for start in range(width):
            for size, (chance, _, _) in windows.items():
                if start + size <= width:
                    ahead[start + size] += ahead[start] * chance[start]
        whole = ahead[sizes, each]
        likely = whole >= 1e-200
        scale = np.where(likely, n[rows] / np.where(likely, whole, 1.0), 0.0)
        for start in reversed(range(width)):
            for size, (chance, _, _) in windows.items():
                if start + size <= width:
                    behind[start] += behind[start + size] * chance[start]
        weights = [ahead[at] * chance[at] * behind[at[0] + size, at[1]] * scale[at[1]] for size, (chance, at, _) in windows.items()]
        seen += np.bincount(np.concatenate([ids for _, _, ids in windows.values()]), np.concatenate(weights), len(seen))
        return rows[~likely].tolist()


@lru_cache(maxsize=1)
def _lattice(pieces: tuple[str, ...], floor: float) -> Lattice:
    """One a worker: its tables are large to send and quick to make."""
    return Lattice(list(pieces), floor)


class Pieces:
    """Windows of code points looked up among pieces and among the strings that pieces end in: by hash, then compared."""

    def __init__(self, pieces: list[str]):
        self.longest = max(map(len, pieces), default=1)
        self.codes = _code_points(pieces, self.longest)
        self.hashes, self.tables = self._hashes(pieces), []
        left = np.arange(len(pieces))
        while len(left):  # a piece whose place is taken has one in the next table
            table = np.full(1 << 20, -1, np.int32)
            table[self._place(self.hashes[left], len(self.tables))[::-1]] = left[::-1]
            self.tables.append(table)
            left = left[table[self._place(self.hashes[left], len(self.tables) - 1)] != left]
        self.ends = np.zeros(1 << 22, bool)
        self.ends[self._hashes(sorted({x[k:] for x in pieces for k in range(len(x))})) * _BASE >> _U(42)] = True

    def _hashes(self, strings: list[str]) -> np.ndarray:
        out = np.zeros(len(strings), _U)
        for size, c in enumerate(_code_points(strings, self.longest)):
            out = np.where(c == _PAD, out, out * _BASE + c + _U(1)) if size else c + _U(1)
        return out

    @staticmethod
    def _place(hashes: np.ndarray, table: int) -> np.ndarray:
        return hashes * (_BASE + _U(2 * table)) * _BASE >> _SHIFT

    def ending(self, codes: np.ndarray, at: np.ndarray, word: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, which, piece) for each size: which of the prefixes ``codes[: at + 1, word]`` end in which piece."""
        which, h, power = np.arange(len(at)), np.zeros(len(at), _U), _U(1)
        for size in range(1, min(self.longest, len(codes)) + 1):
            if size > 1:
                inside = at[which] >= size - 1
                which, h = which[inside], h[inside]
            h = h + (codes[at[which] - (size - 1), word[which]] + _U(1)) * power
            power = _U(int(power) * int(_BASE) & 0xFFFFFFFFFFFFFFFF)
            held = self.ends[h * _BASE >> _U(42)]
            which, h = which[held], h[held]
            if not len(which):
                return
            mine, some, found = h, which, []
            for k, table in enumerate(self.tables):
                piece = table[self._place(mine, k)]
                some, mine, piece = (x[piece >= 0] for x in (some, mine, piece))
                same = self.hashes[piece] == mine
                found.append((some[same], piece[same]))
                some, mine = some[~same], mine[~same]
            ends, piece = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            same = np.ones(len(ends), bool) if size == self.longest else self.codes[size, piece] == _PAD
            for k in range(size):
                same &= codes[at[ends] - (size - 1) + k, word[ends]] == self.codes[k, piece]
            ends, piece = ends[same], piece[same]
            order = np.argsort(ends, kind="stable")
            yield size, ends[order], piece[order]


class Trie:
    """Words by prefix; each node has the best forward score of its prefix and the tokens of the split that has it.

    The score of a prefix is the greatest sum of log probabilities over its
    splits into pieces, and of equal ones the split of fewest tokens counts.
    It depends on the prefix alone, so words that share one share its score. A
    character that no piece covers is as many tokens as it has bytes. The nodes of
    many words are made together, in order of depth.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.logs, self.unknown, self.longest = vocabulary.logs, vocabulary.unknown, vocabulary.longest
        # no piece ends in a string that isn't one of these
        self.ends = {x[k:] for x in self.logs for k in range(len(x))}
        names = [x for x in self.logs if x]
        self.pieces, self.chances = Pieces(names), np.array([self.logs[x] for x in names])
        self.terminals: dict[str, int] = {}
        self.computed = 0  # forward scores so far

    def _step(self, word: str, at: int, path: list[tuple[float, int]]) -> tuple[float, int]:
        """The state of word[:at + 1] from those of the shorter prefixes in ``path``: (score, -tokens), of which the greater pair is the better split."""
        char = word[at]
        best = (-math.inf, 0)
        if char not in self.logs:
            n = len(char.encode("utf-8", "surrogatepass"))
            best = (path[at][0] + n * self.unknown, path[at][1] - n)
        end, get, ends = at + 1, self.logs.get, self.ends
        for start in range(at, max(-1, at - self.longest), -1):
            piece = word[start:end]
            log = get(piece)
            if log is None:
                if piece not in ends:
                    break
            else:
                score, tokens = path[start]
                if (found := (score + log, tokens - 1)) > best:
                    best = found
        self.computed += 1
        return best

    def _alone(self, word: str) -> int:
        """Tokens of a long word, which shares little."""
        path = [(0.0, 0)]
        for at in range(len(word)):
            path.append(self._step(word, at, path))
        return -path[-1][1]

    def _together(self, words: list[str]) -> list[int]:
        """Tokens of distinct words in order, none of them empty or long."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        codes = _code_points(words, int(sizes.max()))
        # a word starts where it leaves the one before
        leaves = np.zeros(len(words), np.int64)
        leaves[1:] = (codes[:, 1:] != codes[:, :-1]).argmax(0)
        depth = np.arange(len(codes))[:, None]
        new = (depth < sizes) & (depth >= leaves)
        at, word = np.nonzero(new)
        node = np.zeros((len(codes) + 1, len(words)), np.int64)  # of each prefix; the empty one's is 0
        node[1:] = np.cumsum(new).reshape(new.shape)
        bounds = np.searchsorted(at, np.arange(len(codes) + 1))
        self.computed += len(at)

        char = codes[at, word]
        n = 1 + (char >= 0x80).astype(np.int64) + (char >= 0x800) + (char >= 0x10000)
        ending = [(size, which, self.chances[piece], node[at[which] + 1 - size, word[which]], np.searchsorted(which, bounds)) for size, which, piece in self.pieces.ending(codes, at, word)]
        known = np.zeros(len(at), bool)
        for size, which, *_ in ending[:1]:
            if size == 1:
                known[which] = True
        score, tokens = np.zeros(len(at) + 1), np.zeros(len(at) + 1, np.int64)
        before = node[at, word]
        for d, (a, z) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            best = np.where(known[a:z], -np.inf, score[before[a:z]] + n[a:z] * self.unknown)
            fewest = np.where(known[a:z], 0, tokens[before[a:z]] - n[a:z])
            for _, which, log, start, cut in ending:
                b, y = cut[d], cut[d + 1]
                if b == y:
                    continue
                to, of = which[b:y] - a, start[b:y]
                s, t = score[of] + log[b:y], tokens[of] - 1
                had = best[to]
                better = (s > had) | ((s == had) & (t > fewest[to]))
                best[to[better]], fewest[to[better]] = s[better], t[better]
            score[a + 1 : z + 1], tokens[a + 1 : z + 1] = best, fewest
        return (-tokens[node[sizes, np.arange(len(words))]]).tolist()

    def count(self, words: list[list[str]]) -> list[int]:
        """Tokens of each list of words."""
        if len(self.terminals) > WORDS:
            self.terminals.clear()
        known = self.terminals
        some, held = [], 0
        for w in sorted(set().union(*words) - known.keys()):
            if not 0 < len(w) <= _LONG:
                known[w] = self._alone(w)
                continue
            some.append(w)
            held += len(w)
            if held > NODES or len(some) >= _SOME:
                known.update(zip(some, self._together(some), strict=True))
                some, held = [], 0
        if some:
            known.update(zip(some, self._together(some), strict=True))
        return [sum(map(known.__getitem__, x)) for x in words]


def pre_tokens(text: str) -> list[str]:
    """Words between blanks, each with the mark of the blank before it."""
    return [BLANK + w for w in text.split()]


#: Expected numbers are summed as multiples of this, so that no order of partitions changes them.
_UNIT = 2.0**-16


def fit(docs: DataFrame, vocabulary: Vocabulary) -> Vocabulary:
    """The vocabulary fitted to all pre-tokens of all documents.

    Distinct pre-tokens with their counts stay on the executors; each round
    brings the driver one number a piece.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                found.update(pre_tokens(t or ""))
                if len(found) > WORDS:
                    yield batch(schema, word=list(found), n=list(found.values()))
                    found.clear()
        yield batch(schema, word=list(found), n=list(found.values()))

    words = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = checkpointed(words.repartition(shuffle_partitions(docs.sparkSession), "word").sortWithinPartitions("word"))
    if words.isEmpty():
        return vocabulary
    names, floor = tuple(vocabulary.logs), math.exp(vocabulary.unknown)
    pieces = pa.schema([("piece", pa.int32()), ("units", pa.int64())])

    def expected(now: dict[str, float]) -> dict[str, float]:
        p = np.array([now[x] for x in names])

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice, seen = _lattice(names, floor), np.zeros(len(p))
            for b in batches:
                lattice.expect(b.column(0).to_pylist(), b.column(1).to_numpy(), p, seen)
            units = np.rint(seen / _UNIT).astype(np.int64)
            held = np.flatnonzero(units)
            yield batch(pieces, piece=held.astype(np.int32), units=units[held])

        found = words.mapInArrow(apply, "piece int, units long").groupBy("piece").agg(F.sum("units").alias("units"))
        return {names[x.piece]: x.units * _UNIT for x in found.orderBy("piece").collect()}

    return vocabulary.maximised(expected)


def token_counts(docs: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """doc_id, n_pre_tokens, n_tokens of every whole text.

    Without a ``vocabulary`` the public one is fitted to the documents (``fit``).
    A null text counts as empty and has no tokens. doc_id passes as it is, null
    or repeated. Other columns are not read. No documents give no rows.
    """
    model = vocabulary or fit(docs, Vocabulary.of_file())
    schema = pa.schema([("doc_id", pa.int64()), ("n_pre_tokens", pa.int64()), ("n_tokens", pa.int64())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(model)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                words = [pre_tokens(t or "") for t in part.column(1).to_pylist()]
                yield batch(schema, doc_id=part.column(0), n_pre_tokens=[len(w) for w in words], n_tokens=np.array(trie.count(words), np.int64))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(apply, "doc_id long, n_pre_tokens long, n_tokens long")
