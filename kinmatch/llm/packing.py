"""Best-fit packing of token sequences, improved by swap-based local search."""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, checkpointed

#: Chunks whose ids a worker remembers; then it starts afresh. Ids don't depend on it.
REMEMBERED = 300_000
#: Pieces that one task packs together, and bins of each group that are opened again.
TOGETHER, LOOSE = 100_000, 64
_coders: dict[str, _Ids] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public vocabulary file's place, as the box offers it."""
    import public_tokenizers

    return public_tokenizers.path(name)


# The words of the tokenizer kind whose texts are put together from words.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
#: Words of these letters are in composed form, and have one lower-case letter for each.
_PLAIN = re.compile(r"[a-zß-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: visible Latin-1 ones for themselves, the rest from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in visible} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in visible)}


class _Ids(dict):
    """Ids of chunks as bytes; a missing one is encoded when asked for."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        split = ((kind.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        normal = [n["type"] for n in (kind.get("normalizer") or {}).get("normalizers", [])]
        words = {"pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True}
        #: Whether texts are put together from blank-separated chunks.
        self.by_words = normal == _NORMALIZERS and words.items() <= split.items()
        self.letters = _byte_letters()
        self[""] = b""

    def plain(self, word: str) -> str:
        """A word as the tokenizer normalises it."""
        return self.tokenizer.normalizer.normalize_str(word)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        # A letter and a sign are never in one word, nor is case kept: most chunks share a word that is known.
        # What counts is the last letter as normalised: a mark, into which some letters end, is a sign as well.
        word = chunk.rstrip(".,;:!?")
        if word != chunk and word and (word.isascii() or (word := self.plain(word))) and word[-1].isalpha():
            ids = self[word] + self[chunk[len(chunk.rstrip(".,;:!?")) :]]
        elif _PLAIN.fullmatch(low := chunk.lower()):
            if low != chunk:
                ids = self[low]
            else:  # one word as it is: only the merges are left to do
                spelt = chunk if chunk.isascii() else chunk.encode().decode("latin-1").translate(self.letters)
                ids = array("I", [t.id for t in self.tokenizer.model.tokenize(spelt)]).tobytes()
        else:
            ids = self.whole(chunk)
        self[chunk] = ids
        return ids


def _ids(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as little-endian 32-bit numbers.

    Words of a tokenizer that drops white space never hold any, and its normaliser acts on
    each side of a blank alone, so a text's ids are those of its
    blank-separated chunks in order, and a chunk needs to be encoded once.
    Texts of other tokenizers are encoded whole.
    """
    known = _coders.get(path)
    if known is None or len(known) > REMEMBERED:
        known = _coders[path] = _Ids(path)
    if not known.by_words:
        return [known.whole(t) for t in texts]
    return [b"".join(map(known.__getitem__, t.replace("\n", " ").split(" "))) for t in texts]


def pieces(docs: DataFrame, tokenizer: str | None = None, most: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's ids with ``end_id`` at the end, cut at ``most`` ids.

    A null text counts as empty: it has the end id alone. The tokenizer's
    file must be at the same path on all executors.
    """
    path = tokenizer or tokenizer_path()
    end = int(end_id).to_bytes(4, "little")
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                ids = b.column(0).slice(at, 256).to_pylist()
                texts = [t or "" for t in b.column(1).slice(at, 256).to_pylist()]
                out: list[list[int]] = [[], [], [], [], []]
                for doc_id, raw in zip(ids, _ids(texts, path), strict=True):
                    raw += end
                    for k, s in enumerate(range(0, len(raw), 4 * most)):
                        part = raw[s : s + 4 * most]
                        for o, x in zip(out, (doc_id, k, s // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                            o.append(x)
                yield batch(schema, **dict(zip(schema.names, out, strict=True)))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(apply, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _lowest(mask: int, least: int) -> int:
    """The lowest set bit from ``least`` on, or -1."""
    rest = mask >> least
    return least + (rest & -rest).bit_length() - 1 if rest else -1


def best_fit(lengths: list[int], most: int) -> list[list[int]]:
    """Best-fit decreasing: bins of indexes of ``lengths``."""
    bins: list[list[int]] = []
    by_gap: dict[int, list[int]] = defaultdict(list)
    mask = 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        gap = _lowest(mask, n)
        if gap < 0:
            k, gap = len(bins), most
            bins.append([])
        else:
            k = by_gap[gap].pop()
            if not by_gap[gap]:
                mask &= ~(1 << gap)
        bins[k].append(i)
        if left := gap - n:
            by_gap[left].append(k)
            mask |= 1 << left
    return bins


@dataclass(frozen=True)
class Effort:
    """How far the search goes; it bounds time alone, every item is packed whatever it is."""

    #: Bins looked at for each exchange, and items of a bin of which pairs are tried.
    partners: int = 24
    items: int = 12
    #: Changes of a bin in a pass, besides one an item, and passes.
    steps: int = 40
    passes: int = 8


class _Search:
    """Moves and exchanges between underfull bins, each raising the sum of squared fills."""

    def __init__(self, bins: list[list[int]], lengths: list[int], most: int, effort: Effort = Effort()):  # noqa: B008
        self.bins, self.n, self.most, self.effort = bins, lengths, most, effort
        self.fill = [sum(lengths[i] for i in b) for b in bins]
        # what a bin could take in place of one of its items (reach), and in its gap
        self.reach: dict[int, set[tuple[int, int]]] = defaultdict(set)
        self.gaps: dict[int, set[int]] = defaultdict(set)
        self.reach_mask = self.gap_mask = 0
        for k in range(len(bins)):
            self._index(k, True)

    def _index(self, k: int, there: bool) -> None:
        gap = self.most - self.fill[k]
        if not 0 < gap < self.most:
            return
        if there:
            self.gaps[gap].add(k)
            self.gap_mask |= 1 << gap
            for i in self.bins[k]:
                self.reach[gap + self.n[i]].add((k, i))
                self.reach_mask |= 1 << (gap + self.n[i])
        else:
            self.gaps[gap].discard(k)
            if not self.gaps[gap]:
                self.gap_mask &= ~(1 << gap)
            for i in self.bins[k]:
                r = gap + self.n[i]
                self.reach[r].discard((k, i))
                if not self.reach[r]:
                    self.reach_mask &= ~(1 << r)

    def _exchange(self, k: int, out: list[int], j: int, back: list[int]) -> None:
        """Items ``out`` of bin k go to bin j, items ``back`` of j to k."""
        for b, gone, come in ((k, out, back), (j, back, out)):
            self._index(b, False)
            self.bins[b] = [i for i in self.bins[b] if i not in gone] + come
            self.fill[b] += sum(self.n[i] for i in come) - sum(self.n[i] for i in gone)
            self._index(b, True)

    def _room(self, k: int, size: int) -> int:
        """The bin other than k with the least gap that holds ``size``."""
        gap = _lowest(self.gap_mask, size)
        while gap >= 0:
            for j in self.gaps[gap]:
                if j != k and self.fill[j] + size > self.fill[k]:
                    return j
            gap = _lowest(self.gap_mask, gap + 1)
        return -1

    def _partner(self, k: int, size: int) -> tuple[int, int] | None:
        """A smaller item of a bin fuller than k after the exchange, for ``size`` of k; the tightest fit first."""
        r, tries = _lowest(self.reach_mask, size), self.effort.partners
        while r >= 0 and tries:
            for j, i in self.reach[r]:
                grows = size - self.n[i]
                if j != k and grows > 0 and self.fill[j] + grows > self.fill[k]:
                    return j, i
                tries -= 1
                if not tries:
                    break
            r = _lowest(self.reach_mask, r + 1)
        return None

    def _step(self, k: int) -> bool:
        """One improving change that takes from bin k."""
        own = sorted(self.bins[k], key=lambda i: (-self.n[i], i))
        for i in own:
            if (j := self._room(k, self.n[i])) >= 0:
                self._exchange(k, [i], j, [])
                return True
        for i in own:
            if found := self._partner(k, self.n[i]):
                self._exchange(k, [i], found[0], [found[1]])
                return True
        for a in range(min(len(own), self.effort.items)):
            for b in range(a + 1, min(len(own), self.effort.items)):
                size = self.n[own[a]] + self.n[own[b]]
                if size < self.most and (found := self._partner(k, size)):
                    self._exchange(k, [own[a], own[b]], found[0], [found[1]])
                    return True
        return False

    def run(self) -> list[list[int]]:
        """Empties bins from the least filled on, each with some changes a pass, until a pass changes nothing."""
        for _ in range(self.effort.passes):
            changed = False
            for k in sorted(range(len(self.bins)), key=lambda k: (self.fill[k], k)):
                for _ in range(self.effort.steps + len(self.bins[k])):
                    if not self.bins[k] or self.fill[k] == self.most or not self._step(k):
                        break
                    changed = True
            if not changed:
                break
        return [b for b in self.bins if b]


def pack(lengths: list[int], most: int, effort: Effort = Effort()) -> list[list[int]]:  # noqa: B008
    """Bins (lists of indexes) of at most ``most`` each: best fit, then local search."""
    return _Search(best_fit(lengths, most), lengths, most, effort).run()


#: Rounds of packing what earlier groups left over; each has hundreds of times fewer pieces than the one before.
_ROUNDS = 8


def _packer(groups: int, round_: int, most: int, loose: int, effort: Effort):
    """Packs one group; the ``loose`` emptiest bins stay open."""

    def apply(key: tuple, t: pa.Table) -> pa.Table:
        order = np.argsort(t["at"].to_numpy(), kind="stable")
        t = t.take(pa.array(order))
        sequence, offset, open_ = np.zeros(t.num_rows, np.int64), np.zeros(t.num_rows, np.int64), np.zeros(t.num_rows, bool)
        lengths = t["length"].to_pylist()
        bins = pack(lengths, most, effort)
        fills = [sum(lengths[i] for i in b) for b in bins]
        again = {k for k in sorted(range(len(bins)), key=fills.__getitem__)[:loose] if fills[k] < most}
        for s, b in enumerate(bins):
            place = 0
            for i in b:
                sequence[i], offset[i], open_[i] = s, place, s in again
                place += lengths[i]
        # even numbers for packed sequences, odd ones for full pieces
        sequence = 2 * (_ROUNDS * (sequence * groups + key[0].as_py()) + round_)
        return t.drop_columns(["at", "grp"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset)).append_column("open", pa.array(open_))

    return apply


def packed(cut: DataFrame, most: int = 2048, together: int = TOGETHER, loose: int = LOOSE, effort: Effort = Effort()) -> DataFrame:  # noqa: B008
    """Adds sequence_id and offset to rows with a length.

    Full pieces are sequences of their own. The others are dealt round-robin to
    groups of about ``together`` rows, whatever their keys, and each group is
    packed by one task. The ``loose`` emptiest bins of each group are opened
    again and their pieces packed together in the same way, until one group
    holds them all, so what dealing costs isn't a bin a group.
    """
    columns = cut.columns
    ddl = ", ".join(f"{c} {t}" for c, t in cut.dtypes) + ", sequence_id long, offset long, open boolean"
    cut = checkpointed(cut)
    full = F.col("length") == most
    done = cut.where(full).withColumn("sequence_id", 2 * F.monotonically_increasing_id() + 1).withColumn("offset", F.lit(0).cast("long"))
    rest, left = cut.where(~full), cut.where(~full).count()
    for round_ in range(_ROUNDS):
        groups = max(1, -(-left // together))
        last = groups == 1 or round_ == _ROUNDS - 1

        # the low 33 bits count within a partition; partitions take turns
        n, at = rest.rdd.getNumPartitions(), F.monotonically_increasing_id()
        grp = ((F.col("at").bitwiseAND((1 << 33) - 1) * n + F.shiftright("at", 33)) % groups).cast("int")
        some = rest.withColumn("at", at).withColumn("grp", grp).groupBy("grp").applyInArrow(_packer(groups, round_, most, 0 if last else loose, effort), ddl)
        if last:
            return done.unionByName(some.drop("open"))
        some = checkpointed(some)
        done = done.unionByName(some.where("NOT open").drop("open"))
        rest = some.where("open").select(*columns)
        left = rest.count()
    raise AssertionError


def packed_documents(docs: DataFrame, tokenizer: str | None = None, most: int = 2048, end_id: int = 0) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every row of ``docs`` is packed, repeated ones too; a null text is empty, a
    null doc_id stays null. Only documents of over ``most`` ids are cut.
    Other columns are not read. No documents give no rows.
    """
    return packed(pieces(docs, tokenizer, most, end_id), most)
