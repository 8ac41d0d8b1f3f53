"""Repeated lines, paragraphs and passages across documents, by digests of normalised units."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, changes, identified, later, merged, mix, shuffle_partitions

#: What ends a unit; it belongs to the unit that it ends. A sentence ends with its line, too.
ENDS = {
    "line": r"\n",
    "paragraph": r"\n(?:[ \t\r]*\n)+",
    "sentence": r"[.!?][ \t\x0B\f\r]+|[。！？]|\n",
}
#: Kinds of units that are looked at, each with the code points, once normalised, from which on neighbouring ones are a passage.
PASSAGES = (("sentence", 150),)
#: Documents whose digests are sorted together before they are sent.
_TOGETHER = 500


def units_of(text: str, ends: re.Pattern) -> list[str]:
    """The units in order; joined they are the text."""
    cuts = [0, *(m.end() for m in ends.finditer(text))]
    if cuts[-1] < len(text):
        cuts.append(len(text))
    return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def normalised(unit: str) -> str:
    """Lower case, runs of ASCII white space as one space, none at the ends."""
    return b" ".join(unit.lower().encode("utf-8", "surrogatepass").split()).decode("utf-8", "surrogatepass")


def passages(text: str, ends: re.Pattern, least: int, seed: int = 0) -> list[tuple[int, int, bytes]]:
    """(start, stop, digest) of the shortest runs of units of ``least`` code points or more, from each unit on and up to each; none starts or ends blank."""
    starts, stops, norms, lengths, at = [], [], [], [], 0
    for unit in units_of(text, ends):
        if n := normalised(unit):
            starts.append(at)
            stops.append(at + len(unit))
            norms.append(n)
            lengths.append(len(n))
        at += len(unit)
    least = max(1, least)
    upto = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    ahead = np.searchsorted(upto, upto[:-1] + least).tolist()
    back = (np.searchsorted(upto, upto[1:] - least, side="right") - 1).tolist()
    runs = [(k, e) for k, e in enumerate(ahead) if e <= len(norms)]
    # most runs are the shortest both ways
    runs += [(k, e + 1) for e, k in enumerate(back) if k >= 0 and ahead[k] != e + 1]
    whole = " ".join(norms)
    place = (upto[:-1] + np.arange(len(norms))).tolist()
    out = []
    for k, e in runs:
        content = whole[place[k] : place[e - 1] + lengths[e - 1]]
        out.append((starts[k], stops[e - 1], xxhash.xxh3_128_digest(content.encode("utf-8", "surrogatepass"), seed)))
    return out


def repeated_passages(named: DataFrame, kinds: tuple[tuple[str, int], ...] = PASSAGES) -> DataFrame:
    """(did, tid, start, stop): these code points of a document, a passage, also stand at an earlier (did, tid, start).

    ``named`` is what ``identified`` returns. Of equal digests among documents
    that are read together only the earliest travels, so a passage of a third
    of all documents is no hot group; the others are known to be repeats and
    are dealt by document.
    """
    patterns = [(re.compile(ENDS[unit]), least) for unit, least in kinds]
    schema = pa.schema([("key", pa.int64()), ("second", pa.int64()), ("did", pa.int64()), ("tid", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("sure", pa.bool_())])
    ddl = "key long, second long, did long, tid long, start long, stop long, sure boolean"

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, _TOGETHER):
                part = b.slice(at, _TOGETHER)
                found = [[p for seed, (ends, least) in enumerate(patterns) for p in passages(t, ends, least, seed)] for t in part.column(2).to_pylist()]
                n = [len(x) for x in found]
                if not sum(n):
                    continue
                did, tid = (np.repeat(part.column(k).to_numpy(), n) for k in (0, 1))
                start, stop = (np.array([p[k] for x in found for p in x], np.int64) for k in (0, 1))
                key, second = np.frombuffer(b"".join(p[2] for x in found for p in x), np.int64).reshape(-1, 2).T
                order = np.lexsort((start, tid, did, second, key))
                key, second, did, tid, start, stop = (x[order] for x in (key, second, did, tid, start, stop))
                sure = later(changes(key, second), did, tid, start)
                key[sure] = mix(did[sure].view(np.uint64)).view(np.int64)
                yield batch(schema, key=key, second=second, did=did, tid=tid, start=start, stop=stop, sure=sure)

    found = named.select("did", "tid", "text").mapInArrow(digests, ddl)
    found = found.repartition(shuffle_partitions(named.sparkSession), "key").sortWithinPartitions("sure", "key", "second", "did", "tid", "start")
    out = pa.schema([schema.field(c) for c in ("did", "tid", "start", "stop")])

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Streams over sorted rows; the first row of the latest digest stays for the next batch."""
        head = None
        for b in batches:
            c = [b.column(k).to_numpy(zero_copy_only=False) for k in range(7)]
            if (sure := c[6]).any():
                yield batch(out, did=c[2][sure], tid=c[3][sure], start=c[4][sure], stop=c[5][sure])
            c = [x[~sure] for x in c[:6]]
            if not len(c[0]):
                continue
            if head is not None:
                c = [np.concatenate([h, x]) for h, x in zip(head, c, strict=True)]
            new = changes(c[0], c[1])
            again = later(new, c[2], c[3], c[4])
            if again.any():
                yield batch(out, did=c[2][again], tid=c[3][again], start=c[4][again], stop=c[5][again])
            k = int(np.flatnonzero(new)[-1])
            head = [x[k : k + 1] for x in c]

    return found.mapInArrow(repeats, "did long, tid long, start long, stop long")


def without_repeats(docs: DataFrame, kinds: tuple[tuple[str, int], ...] = PASSAGES, carry: tuple[str, ...] = ()) -> DataFrame:
    """Removes every passage that occurred before, at whatever distance.

    A passage is a run of neighbouring units of one of the ``kinds`` (unit,
    least), blank ones apart, from some unit on or up to some unit, no longer
    than it takes to have ``least`` code points; longer ones are covered by such
    runs. With ``("line", 1)`` it is a single line of any length. It is compared
    lower-cased with white space collapsed, and ranks by (doc_id, place).
    Passages are judged on the input. Each unit that goes is there in an
    earlier place, so its first occurrence stays.

    Returns for each row doc_id, kept_text (what is left, unchanged),
    n_removed, chars_removed, spans (array of start, stop: the maximal removed
    runs of code points of the original text, in order), and the columns named
    in ``carry``, unchanged. A null text counts as empty. Rows equal in doc_id
    and text are one document; a null doc_id ranks last. No rows give no rows.
    """
    named = identified(docs, *(F.col(c).alias(f"__carry_{k}") for k, c in enumerate(carry)))
    gone = repeated_passages(named, kinds)
    gone = gone.groupBy("did", "tid").agg(F.collect_list(F.struct("start", "stop")).alias("gone"))
    kept = [f"__carry_{k}" for k in range(len(carry))]
    joined = named.join(gone, ["did", "tid"], "left").select("doc_id", "text", "gone", *kept)
    types = dict(joined.dtypes)
    ddl = "doc_id long, kept_text string, n_removed long, chars_removed long, spans array<struct<start:long,stop:long>>"
    ddl += "".join(f", {c} {types[c]}" for c in kept)
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    own = [("doc_id", pa.int64()), ("kept_text", pa.string()), ("n_removed", pa.int64()), ("chars_removed", pa.int64()), ("spans", span)]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, lists = b.column(1).to_pylist(), b.column(2)
            bounds, flat = lists.offsets.to_numpy(), lists.values
            start, stop = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("start", "stop"))
            valid = lists.is_valid().to_numpy(zero_copy_only=False)
            left, spans = [], []
            for k, text in enumerate(texts):
                cut = merged(start[bounds[k] : bounds[k + 1]], stop[bounds[k] : bounds[k + 1]]) if valid[k] else []
                spans.append([{"start": s, "stop": e} for s, e in cut])
                edges = [0, *(x for c in cut for x in c), len(text)]
                left.append("".join(text[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True)))
            gone = [sum(s["stop"] - s["start"] for s in x) for x in spans]
            schema = pa.schema([*own, *((c, b.schema.field(c).type) for c in kept)])
            yield batch(schema, doc_id=b.column(0), kept_text=left, n_removed=[len(x) for x in spans], chars_removed=gone, spans=spans, **{c: b.column(3 + k) for k, c in enumerate(kept)})

    done = joined.mapInArrow(apply, ddl)
    for k, c in enumerate(carry):
        done = done.withColumnRenamed(f"__carry_{k}", c)
    return done


def digest_columns(out: DataFrame) -> DataFrame:
    """Scalar columns of the result: the spans as start-stop, comma-separated, in order."""
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s.start.cast("string"), s.stop.cast("string"))), ",")
    return out.select("doc_id", "n_removed", "chars_removed", spans.alias("removed"), F.sha2("kept_text", 256).alias("kept_sha256"))


#: DuckDB SQL for digest_columns(without_repeats(documents)): passages as strings, not as digests.
ORACLE = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '(?s).*?(?:[.!?][ \t\x0B\f\r]+|[。！？]|\n)|.+\z') AS units FROM documents),
u AS (SELECT doc_id, unnest(units) AS unit, generate_subscripts(units, 1) AS pos FROM t),
n AS (SELECT *, trim(regexp_replace(lower(unit), '[ \t\x0B\f\r\n]+', ' ', 'g'), ' ') AS norm FROM u),
c AS (
  SELECT *, coalesce(sum(length(unit)) OVER (p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins,
         (sum(length(norm)) OVER (p ROWS UNBOUNDED PRECEDING))::BIGINT AS upto,
         count(*) FILTER (norm <> '') OVER (p ROWS UNBOUNDED PRECEDING) - 1 AS blanks
  FROM n WINDOW p AS (PARTITION BY doc_id ORDER BY pos)),
f AS (SELECT *, upto - length(norm) AS since FROM c WHERE norm <> ''),
s AS (SELECT doc_id, string_agg(norm, ' ' ORDER BY pos) AS whole FROM f GROUP BY doc_id),
w AS (
  SELECT a.doc_id, a.pos, b.pos AS last, a.since + a.blanks AS begins, b.upto + b.blanks AS ends
  FROM f a ASOF JOIN f b ON a.doc_id = b.doc_id AND a.since + 150 <= b.upto
  UNION
  SELECT a.doc_id, a.pos, b.pos, a.since + a.blanks, b.upto + b.blanks
  FROM f b ASOF JOIN f a ON a.doc_id = b.doc_id AND b.upto >= a.since + 150),
m AS (
  SELECT w.doc_id, pos, last, row_number() OVER (PARTITION BY substr(whole, w.begins + 1, ends - w.begins) ORDER BY w.doc_id, pos) > 1 AS again
  FROM w JOIN s ON w.doc_id = s.doc_id),
g AS (SELECT doc_id, pos, max(last) AS last FROM m WHERE again GROUP BY doc_id, pos),
r AS (
  SELECT c.doc_id, c.pos, c.unit, c.begins,
         coalesce(max(last) OVER (PARTITION BY c.doc_id ORDER BY c.pos ROWS UNBOUNDED PRECEDING) >= c.pos, FALSE) AS gone
  FROM c LEFT JOIN g ON c.doc_id = g.doc_id AND c.pos = g.pos),
i AS (
  SELECT doc_id, min(begins) AS begins, max(begins + length(unit)) AS ends
  FROM (SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM r WHERE gone) GROUP BY doc_id, island),
e AS (
  SELECT doc_id, count(*) AS n, sum(ends - begins) AS chars, string_agg(begins || '-' || ends, ',' ORDER BY begins) AS removed
  FROM i GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(unit, '' ORDER BY pos) AS kept FROM r WHERE NOT gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_removed, coalesce(chars, 0)::BIGINT AS chars_removed, coalesce(removed, '') AS removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN e ON d.doc_id = e.doc_id LEFT JOIN k ON d.doc_id = k.doc_id
"""
