"""Language identification by mixtures of languages over n-gram likelihoods.

A document is a mixture: each of its words is of one of the learned languages,
with the likelihood of its character trigrams. Expectation-maximisation finds
the proportions; of the nested sets of its largest languages the one of the
greatest penalised likelihood is the document's language set.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch

UNKNOWN = "und"
#: Trigrams are counted in so many hash buckets a language.
BUCKETS = 1 << 16
#: Code points handled together.
_CHUNK = 1 << 19
_letters: np.ndarray | None = None


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]  # by code point
    logs: np.ndarray  # (BUCKETS, languages): log likelihood of a trigram


def _is_letter(codes: np.ndarray) -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters[codes]


def _features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of lower-case code points: places of the letters, their trigrams' buckets, which letters begin a word.

    A trigram stands around each letter; all that is no letter counts as a blank.
    """
    letter = _is_letter(codes)
    c = np.where(letter, codes, 32).astype(np.uint64)
    at = np.flatnonzero(letter)
    padded = np.concatenate([[np.uint64(32)], c, [np.uint64(32)]]).astype(np.uint64)
    h = padded[at] * np.uint64(0x9E3779B97F4A7C15) + c[at] * np.uint64(0xC2B2AE3D27D4EB4F) + padded[at + 2] * np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    begins = np.ones(len(at), bool)
    begins[1:] = at[1:] != at[:-1] + 1
    return at, (h >> np.uint64(48)).astype(np.int64), begins


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _parts(codes: np.ndarray) -> Iterator[np.ndarray]:
    """About _CHUNK code points at a time, cut where a letter doesn't meet a letter."""
    start = 0
    while start < len(codes):
        stop = min(len(codes), start + _CHUNK)
        while stop < len(codes) and _is_letter(codes[stop - 1]) and _is_letter(codes[stop]):
            gap = np.flatnonzero(~_is_letter(codes[stop : stop + _CHUNK]))
            stop = stop + int(gap[0]) if len(gap) else min(len(codes), stop + _CHUNK)
        yield codes[start:stop]
        start = stop


def held_out():
    """Whether the CRC-32 of doc_id, as text, leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, documents: int = 20_000, smoothing: float = 0.5) -> Model:
    """Trigram counts by language of labelled documents that aren't held out.

    ``documents`` bounds the sample: where more are labelled, those of which
    the hash of doc_id is small enough to expect that many are read. Counts are
    summed on the executors; the driver gets at most BUCKETS numbers for each
    language found in the sample.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    share = documents / max(1, labelled.count())
    if share < 1:
        labelled = labelled.where(F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30)))
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                have = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for part in _parts(_codes(text)):
                    have += np.bincount(_features(part)[1], minlength=BUCKETS)
        for lang, have in total.items():
            k = np.flatnonzero(have)
            yield batch(schema, lang=[lang] * len(k), bucket=k, n=have[k])

    counts = labelled.select("lang", "text").mapInArrow(count, "lang string, bucket long, n long")
    found = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = found["lang"].to_pylist()
    languages = tuple(sorted(set(langs)))
    table = np.zeros((BUCKETS, len(languages)))
    place = {x: k for k, x in enumerate(languages)}
    table[found["bucket"].to_numpy(), [place[x] for x in langs]] = found["n"].to_numpy()
    seen = max(1, int((table.sum(axis=1) > 0).sum()))
    logs = np.log((table + smoothing) / (table.sum(axis=0) + smoothing * seen))
    return Model(languages, logs.astype(np.float32))


def _word_logs(texts: list[str], model: Model) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Rows of ``texts`` with a letter, each with its number of words, and the words' log likelihoods; whole texts."""
    rows: list[int] = []
    counts: list[int] = []
    parts: list[np.ndarray] = []
    held: list[tuple[int, np.ndarray]] = []
    size = 0

    def flush():
        codes = np.concatenate([x for _, c in held for x in (c, _BLANK)])
        at, buckets, begins = _features(codes)
        if not len(at):
            return
        starts = np.flatnonzero(begins)
        logs = np.add.reduceat(model.logs[buckets], starts, axis=0, dtype=np.float32)
        ends = np.cumsum([len(c) + 1 for _, c in held])
        n = np.diff(np.searchsorted(at[starts], ends, side="left"), prepend=0)
        done = 0
        for (row, _), k in zip(held, n.tolist(), strict=True):
            if k:
                if rows and rows[-1] == row:
                    counts[-1] += k
                else:
                    rows.append(row)
                    counts.append(k)
                parts.append(logs[done : done + k])
                done += k

    for row, text in enumerate(texts):
        for part in _parts(_codes(text)):
            held.append((row, part))
            size += len(part)
            if size >= _CHUNK:
                flush()
                held, size = [], 0
        if not held and rows:
            yield rows, np.array(counts), np.concatenate(parts)
            rows, counts, parts = [], [], []
    if held:
        flush()
    if rows:
        yield rows, np.array(counts), np.concatenate(parts)


_BLANK = np.array([32], np.uint32)


def _mixtures(logs: np.ndarray, counts: np.ndarray, allowed: np.ndarray, rounds: int = 60, settled: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log likelihood of each document by EM over its allowed languages."""
    docs, langs = len(counts), logs.shape[1]
    p = allowed / allowed.sum(axis=1, keepdims=True)
    best = logs.max(axis=1)
    like = np.exp(logs - best[:, None])
    doc = np.repeat(np.arange(docs), counts)
    final = np.zeros(docs)
    active = np.arange(docs)
    a_like, a_best, a_counts, a_doc = like, best, counts, doc
    for k in range(rounds):
        share = a_like * p[a_doc]
        total = np.maximum(share.sum(axis=1), 1e-30)
        starts = np.cumsum(a_counts) - a_counts
        final[active] = np.add.reduceat(np.log(total) + a_best, starts)
        share /= total[:, None]
        new = np.add.reduceat(share, starts, axis=0) / a_counts[:, None]
        moving = np.abs(new - p[active]).max(axis=1) > settled
        p[active] = new
        if not moving.any() or k == rounds - 1:
            break
        if moving.sum() < 0.7 * len(active):  # only those that still move go on
            keep = np.repeat(moving, a_counts)
            active, a_counts = active[moving], a_counts[moving]
            a_like, a_best, a_doc = a_like[keep], a_best[keep], a_doc[keep]
    return p, final


def identify(texts: list[str | None], model: Model, penalty: float = 6.0) -> tuple[list[str], list[float]]:
    """The main language of each text and its proportion; ``und`` and 0 where there is no letter or nothing learned.

    A set of m languages must be worth penalty * (m - 1) * log(words) / 2 in
    log likelihood.
    """
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not model.languages:
        return names, scores
    for rows, counts, logs in _word_logs([t or "" for t in texts], model):
        langs = len(model.languages)
        starts = np.cumsum(counts) - counts
        alone = np.add.reduceat(logs.astype(np.float64), starts, axis=0)
        chosen = alone.argmax(axis=1)
        score = np.ones(len(rows))
        if langs > 1:
            p, full = _mixtures(logs, counts, np.ones((len(rows), langs)))
            cost = penalty * np.log(np.maximum(counts, 2)) / 2
            value = alone.max(axis=1)
            # no set is likelier than all languages together: most documents are settled here
            open_ = np.flatnonzero(full - cost > value)
            rank = np.argsort(-p, axis=1, kind="stable")
            for m in range(2, langs + 1):
                if not len(open_):
                    break
                allowed = np.zeros((len(open_), langs))
                np.put_along_axis(allowed, rank[open_, :m], 1.0, axis=1)
                words = np.repeat(np.isin(np.arange(len(rows)), open_), counts)
                q, like = _mixtures(logs[words], counts[open_], allowed)
                better = like - cost[open_] * (m - 1) > value[open_]
                won = open_[better]
                value[won] = (like - cost[open_] * (m - 1))[better]
                chosen[won] = q[better].argmax(axis=1)
                score[won] = q[better].max(axis=1)
                open_ = open_[full[open_] - cost[open_] * m > value[open_]]
        for k, row in enumerate(rows):
            names[row], scores[row] = model.languages[chosen[k]], float(min(1.0, score[k]))
    return names, scores


def with_language(docs: DataFrame, model: Model, names: tuple[str, str] = ("lang_pred", "score"), penalty: float = 6.0) -> DataFrame:
    """All rows and columns of ``docs`` (which has no column of these names), with language and score."""
    if set(names) & set(docs.columns):
        raise ValueError(f"there are columns named {names} already")
    ddl = ", ".join([f"`{c}` {t}" for c, t in docs.dtypes] + [f"`{names[0]}` string", f"`{names[1]}` double"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 1000):
                part = b.slice(s, 1000)
                lang, score = identify(part.column(part.schema.get_field_index("text")).to_pylist(), model, penalty)
                yield part.append_column(names[0], pa.array(lang, pa.string())).append_column(names[1], pa.array(score, pa.float64()))

    return docs.mapInArrow(apply, ddl)


def languages(docs: DataFrame, documents: int = 20_000) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs`` from its whole text.

    lang serves to learn from documents that aren't held out, never to predict.
    A null text, or one without letters, is ``und`` with score 0, and so is
    everything where no label is left to learn from. A null doc_id isn't held
    out and isn't learned from. Repeated rows get equal results. Of languages
    equally likely the first by code point is taken. Other columns are not
    read. No documents give no rows.
    """
    model = learn(docs, documents)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return with_language(named, model).select("doc_id", "held_out", "lang_pred", "score")
