"""Removal of repeated 50-byte strings by prefix-free parsing.

A rolling hash of 24-byte grams sets off triggers: of any 50 bytes, the place of least gram hash. Between triggers lie
the phrases: the runs of 50-byte windows that share a trigger, with the bytes they cover. Equal windows have equal
triggers at equal distance, so every repeat is found among the phrases of equal trigger grams:

* Phrases of the dictionary are told apart by trigger and fingerprint (64 bits each). One that stands in several
  documents is repeated as a whole; only its first document keeps it.
* Where a trigger has several phrases, those of the dictionary are fetched as bytes and put in order. What stands before
  a trigger (the suffixes of the dictionary's phrases) and what follows it (the suffixes of the parse, which begin at
  triggers) are sorted each, with the length that neighbours have in common. A window takes k bytes from the one order
  and 50 - k from the other, so its place in corpus order, to the depth of 50 bytes, is that of its two parts. Windows of
  one place are equal byte by byte, and the smallest document keeps them.

A worker settles repeats within its own batch, and against phrases that it has often seen, before anything is shuffled.
Stretches of one phrase again and again (runs of a byte, rulers) are one row. Groups of one trigger pass through a
worker as a stream; the dictionary of a trigger with more than HOT_PHRASES of them is dealt by windows instead.

Defined cases: a null text is empty; texts of fewer than 50 bytes lose nothing; of rows that share an id none is before
the other, and their marks are kept apart by a hash of the text; a null id is before all others; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, fresh_name, materialize

WINDOW, GRAM = 50, 24
SPANS = "repeat_spans"
#: Bytes that a worker parses together.
CHUNK_BYTES = 768 << 10
#: Repeated phrases that a worker remembers from batch to batch.
KNOWN_PHRASES = 200_000
#: Phrases of one trigger up to which they are compared in one group.
HOT_PHRASES = 4096
_P, _M1, _M2 = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BYTES = np.random.default_rng(20_50).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_INVERSE = pow(_P, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of the rolling hash's base and of its inverse, as long as they were needed so far."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _P, np.uint64)])
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _INVERSE, np.uint64)])
        return self.up, self.down


POWERS = _Powers()


class Parsed:
    """Texts one after the other, with prefix hashes: any stretch of bytes is hashed in constant time."""

    def __init__(self, texts: list[bytes]):
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        up, self.down = POWERS.of(len(self.data) + 1)
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[self.data] * up[: len(self.data)])])

    def hashes(self, at: np.ndarray, to: np.ndarray) -> np.ndarray:
        return _mix((self.prefix[to] - self.prefix[at]) * self.down[at])

    def phrases(self) -> tuple[np.ndarray, ...]:
        """Of every phrase: text number, first window (byte of the text), windows, hash of the trigger, own hash, place of
        the trigger after the first window's start."""
        n, span = len(self.data), WINDOW - GRAM + 1
        if n < WINDOW:
            return tuple(np.zeros(0, np.int64) for _ in range(6))
        gram = _mix((self.prefix[GRAM:] - self.prefix[:-GRAM]) * self.down[: n - GRAM + 1])
        least, width = gram.copy(), 1
        while width < span:
            step = min(width, span - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        # The trigger of a window is the first place of its least gram hash.
        windows = n - WINDOW + 1
        spots = np.flatnonzero(self._marks(gram, least, span))
        nxt = np.searchsorted(spots, np.arange(windows))
        trigger = spots[np.minimum(nxt, len(spots) - 1)]
        # The first marked place at or after the window's start may not be the least one: step on while it is not.
        wrong = np.flatnonzero(gram[trigger] != least)
        while len(wrong):
            nxt[wrong] += 1
            trigger[wrong] = spots[nxt[wrong]]
            wrong = wrong[gram[trigger[wrong]] != least[wrong]]
        text = np.repeat(np.arange(len(self.lengths)), self.lengths)
        inside = text[:windows] == text[WINDOW - 1 :]
        first = np.flatnonzero(inside & np.r_[True, (trigger[1:] != trigger[:-1]) | ~inside[:-1] | (text[1:windows] != text[: windows - 1])])
        if not len(first):
            return tuple(np.zeros(0, np.int64) for _ in range(6))
        runs = np.cumsum(inside)
        last = np.r_[first[1:], windows]
        count = runs[last - 1] - runs[first] + 1
        own = self.hashes(first, first + count + WINDOW - 1)
        own = _mix(own ^ (trigger[first] - first).astype(np.uint64) * np.uint64(_P))
        return text[first], first - self.starts[text[first]], count, gram[trigger[first]], own, trigger[first] - first

    @staticmethod
    def _marks(gram: np.ndarray, least: np.ndarray, span: int) -> np.ndarray:
        """Places whose gram hash is the least of some window that they are in."""
        top = np.full(span - 1, 0, np.uint64)
        padded = np.concatenate([top, least, top])
        most, width = padded, 1
        while width < span:
            step = min(width, span - width)
            most = np.maximum(most[:-step], most[step:])
            width += step
        # The greatest of the minima of all windows over a place is its own hash if it is least in one of them.
        return most[: len(gram)] == gram


PHRASES = "trigger long, phrase long, doc long, text_hash long, at int, shape long"
MARKS = "trigger long, doc long, text_hash long, at int, shape long, whole boolean"
SPANS_OF = "doc long, text_hash long, at int, windows long"
LOWEST = -(2**63)


def _raw(texts) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]


def _batch(schema: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in schema.split(", ")])


def _chunks(batches, size=CHUNK_BYTES):
    """Rows of some CHUNK_BYTES of text, by id: (ids, text hashes, texts as bytes, the other columns)."""
    rows, held = [], 0

    def out():
        rows.sort(key=lambda r: r[0])
        ids, hashes, texts, rest = zip(*rows, strict=True)
        return np.array(ids, np.int64), np.array(hashes, np.int64), list(texts), rest

    for batch in batches:
        for k, h, raw, *more in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _raw(batch.column(2).to_pylist()), *(c.to_pylist() for c in batch.columns[3:]), strict=True):
            rows.append((k, h, raw, more))
            held += len(raw)
            if held >= size:
                yield out()
                rows, held = [], 0
    if rows:
        yield out()


def _shape(repeats, windows, offset):
    """A phrase's form in one number: times in a row, windows, and the trigger's place in it."""
    return repeats << 10 | windows << 5 | offset


class Known:
    """Repeated phrases and the smallest document seen with each, bounded in number."""

    def __init__(self):
        self.phrase, self.least = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def before(self, phrase: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Whether a smaller document is known to have the phrase."""
        if not len(self.phrase):
            return np.zeros(len(phrase), bool)
        spot = np.minimum(np.searchsorted(self.phrase, phrase), len(self.phrase) - 1)
        return (self.phrase[spot] == phrase) & (self.least[spot] < doc)

    def add(self, phrase: np.ndarray, least: np.ndarray) -> None:
        # The newest come first, so that they are the ones kept.
        phrase, least = np.r_[phrase, self.phrase], np.r_[least, self.least]
        phrase, least = phrase[: 2 * KNOWN_PHRASES], least[: 2 * KNOWN_PHRASES]
        order = np.lexsort((least, phrase))
        first = np.r_[True, phrase[order][1:] != phrase[order][:-1]]
        keep = np.sort(order[first])[:KNOWN_PHRASES]
        keep = keep[np.argsort(phrase[keep], kind="stable")]
        self.phrase, self.least = phrase[keep], least[keep]


def parse(df: DataFrame) -> DataFrame:
    """Phrases of (doc, text_hash, text): a row for a phrase, first document and batch; what the batch settles itself has
    the negative number of its windows as its shape."""

    def run(batches):
        known = Known()
        for ids, hashes, texts, _ in _chunks(batches):
            number, at, windows, trigger, own, offset = Parsed(texts).phrases()
            if not len(number):
                continue
            # One phrase several times in a row is one row.
            new = np.r_[True, (own[1:] != own[:-1]) | (number[1:] != number[:-1]) | (at[1:] != at[:-1] + windows[:-1])]
            times = np.diff(np.r_[np.flatnonzero(new), len(new)])
            number, at, windows, trigger, own, offset = (x[new] for x in (number, at, windows, trigger, own, offset))
            doc = ids[number]
            # Texts are in order of their ids, so a phrase's first row is its smallest document's.
            order = np.argsort(own, kind="stable")
            o, d = own[order], doc[order]
            first = np.r_[True, o[1:] != o[:-1]]
            least = d[first][np.cumsum(first) - 1]
            again = np.zeros(len(own), bool)
            again[order] = d > least
            twice = np.flatnonzero(d > least)
            again |= known.before(own, doc)
            if len(twice):
                one = np.unique(o[twice], return_index=True)[1]
                known.add(o[twice][one], least[twice][one])
            # A phrase twice in its first document goes on twice: both places lose it if another document is before.
            # Repeats are settled here; neighbouring ones are joined.
            where = np.flatnonzero(again)
            start, stop = at[where], at[where] + windows[where] * times[where]
            begin = ends = np.zeros(0, np.int64)
            if len(where):
                begin = np.flatnonzero(np.r_[True, (number[where][1:] != number[where][:-1]) | (start[1:] > stop[:-1])])
                ends = np.r_[begin[1:], len(where)] - 1
            keep = np.flatnonzero(~again)
            n = where[begin]
            yield _batch(
                PHRASES,
                np.r_[trigger[keep], own[n]].astype(np.int64), np.r_[own[keep], np.zeros(len(n), np.uint64)].astype(np.int64), np.r_[doc[keep], doc[n]],
                hashes[np.r_[number[keep], number[n]]], np.r_[at[keep], start[begin]].astype(np.int32), np.r_[_shape(times[keep], windows[keep], offset[keep]), start[begin] - stop[ends]],
            )

    return df.mapInArrow(run, PHRASES)


def settle(phrases: DataFrame) -> DataFrame:
    """Marks: phrases that are repeated as a whole, and those whose windows have to be compared (whole = false).

    Rows come by trigger, phrase and document. A group that goes on in the next batch is carried over by at most four of
    its rows once it is known that its phrases are to be compared; before that, by the rows of its only document.
    """

    def run(batches):
        carried, seen = None, np.zeros(0, bool)
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            done = cols[5] < 0
            if done.any():
                _, _, doc, text_hash, at, shape = (c[done] for c in cols)
                yield _batch(MARKS, np.zeros(len(doc), np.int64), doc, text_hash, at, shape, np.ones(len(doc), bool))
                cols = [c[~done] for c in cols]
            if not len(cols[0]):
                continue
            old = np.r_[seen, np.zeros(len(cols[0]), bool)]
            if carried is not None:
                cols = [np.concatenate(x) for x in zip(carried, cols, strict=True)]
            trigger, phrase, doc, text_hash, at, shape = cols
            new = np.r_[True, trigger[1:] != trigger[:-1]]
            begin, group = np.flatnonzero(new), np.cumsum(new) - 1
            other = new | np.r_[True, phrase[1:] != phrase[:-1]]
            first = np.flatnonzero(other)
            least = doc[first][np.cumsum(other) - 1]
            # A phrase can have a part in common with another of its trigger only if that one is first elsewhere.
            several = (np.add.reduceat(other.astype(np.int64), begin) > 1) & (np.minimum.reduceat(doc, begin) != np.maximum.reduceat(least, begin))
            whole = (doc > least) & ~old
            compare = several[group] & ~whole & ~old
            keep = np.flatnonzero(whole | compare)
            yield _batch(MARKS, trigger[keep], doc[keep], text_hash[keep], at[keep], shape[keep], whole[keep])
            if several[-1]:
                tail = doc[begin[-1] :]
                on = np.unique([begin[-1], begin[-1] + tail.argmin(), begin[-1] + least[begin[-1] :].argmax(), first[-1]])
                seen = np.ones(len(on), bool)
            else:
                on = begin[-1] + np.flatnonzero(~whole[begin[-1] :])
                seen = np.zeros(len(on), bool)
            carried = [c[on] for c in cols]

    spread = int(phrases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return phrases.repartition(spread, "trigger").sortWithinPartitions("trigger", "phrase", "doc").mapInArrow(run, MARKS)


DICTIONARY = "key long, doc long, text_hash long, at int, shape long, body binary"


def dictionary(df: DataFrame, marks: DataFrame) -> DataFrame:
    """Bytes of the phrases that are to be compared, under their trigger; those of hot triggers window by window."""
    todo = marks.filter("not whole")
    hot = todo.groupBy("trigger").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > HOT_PHRASES).select("trigger", F.lit(True).alias("hot"))
    todo = todo.join(hot, "trigger", "left").groupBy("doc", "text_hash").agg(F.collect_list(F.struct("trigger", "at", "shape", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("todo"))
    # Both sides grow with the documents, so neither is broadcast.
    rows = df.join(todo.hint("merge"), ["doc", "text_hash"]).select("doc", "text_hash", "text", "todo")

    def run(batches):
        for ids, hashes, texts, rest in _chunks(batches):
            p = None
            keys, which, places, shapes, bodies = [], [], [], [], []
            for i, (marks_of,) in enumerate(rest):
                text = texts[i]
                for m in marks_of:
                    at, shape = m["at"], m["shape"]
                    n = shape >> 5 & 31
                    if m["hot"]:
                        p = p or Parsed(texts)
                        at = np.arange(at, at + n)
                        whole = p.starts[i] + at
                        keys += p.hashes(whole, whole + WINDOW).astype(np.int64).tolist()
                        places += at.tolist()
                        shapes += [_shape(shape >> 10, 0, n)] * n
                        bodies += [text[a : a + WINDOW] for a in at.tolist()]
                        which += [i] * n
                    else:
                        keys.append(m["trigger"])
                        places.append(at)
                        shapes.append(shape)
                        bodies.append(text[at : at + n + WINDOW - 1])
                        which.append(i)
            which = np.array(which, np.int64)
            for k in range(0, len(which), 50_000):
                c = slice(k, k + 50_000)
                yield _batch(DICTIONARY, np.array(keys[c], np.int64), ids[which[c]], hashes[which[c]], np.array(places[c], np.int32), np.array(shapes[c], np.int64), pa.array(bodies[c], pa.binary()))

    return rows.mapInArrow(run, DICTIONARY)


def _order(key: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each row of bytes under its key, and the length in common with the one before (-1: another key)."""
    words = np.pad(parts, ((0, 0), (0, -parts.shape[1] % 8))).view(">u8")
    order = np.lexsort((*words.T[::-1], key))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    differ = parts[order][1:] != parts[order][:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), parts.shape[1])
    common[key[order][1:] != key[order][:-1]] = -1
    return rank, np.r_[-1, common]


def repeated_parts(key: np.ndarray, doc: np.ndarray, shape: np.ndarray, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, window) of all windows in phrases of equal key that a smaller document has."""
    reach = WINDOW - GRAM
    windows, offset = shape >> 5 & 31, shape & 31
    # Every phrase with its trigger in one column; what it lacks at the ends is zero and below the depth asked for.
    raw = np.frombuffer(b"".join(b.rjust(len(b) + reach - o, b"\0").ljust(reach + WINDOW, b"\0") for b, o in zip(bodies, offset.tolist(), strict=True)), np.uint8).reshape(-1, reach + WINDOW)
    before, common_before = _order(key, raw[:, reach - 1 :: -1])
    after, common_after = _order(key, raw[:, reach:])
    rows, at = [], []
    for k in range(reach + 1):
        some = np.flatnonzero((offset >= k) & (offset - windows < k))
        if not len(some):
            continue
        left, right = np.cumsum(common_before < k)[before[some]], np.cumsum(common_after < WINDOW - k)[after[some]]
        order = np.lexsort((doc[some], left, right))
        l, r, d = left[order], right[order], doc[some][order]
        new = np.r_[True, (l[1:] != l[:-1]) | (r[1:] != r[:-1])]
        again = some[order[d > d[new][np.cumsum(new) - 1]]]
        rows.append(again)
        at.append(offset[again] - k)
    return np.concatenate([np.zeros(0, np.int64), *rows]), np.concatenate([np.zeros(0, np.int64), *at])


def _held(batches):
    """Arrow batches of sorted rows, cut where the first column changes."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        key = rest.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1], side="left"))
        if cut:
            yield rest.slice(0, cut).combine_chunks()
            rest = rest.slice(cut).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def repeated_in_phrases(phrases: DataFrame) -> DataFrame:
    """Windows of the dictionary that a smaller document has, from the order of the phrases' two parts."""

    def run(batches):
        for table in _held(batches):
            key, doc, text_hash, at, shape = (table.column(c).to_numpy() for c in range(5))
            row, window = repeated_parts(key, doc, shape, table.column(5).to_pylist())
            if not len(row):
                continue
            order = np.lexsort((window, row))
            row, window = row[order], window[order]
            new = np.r_[True, (row[1:] != row[:-1]) | (window[1:] != window[:-1] + 1)]
            first = np.flatnonzero(new)
            n, row, window = np.diff(np.r_[first, len(new)]), row[first], window[first]
            yield _spans(doc[row], text_hash[row], at[row] + window, n, shape[row] >> 10, shape[row] >> 5 & 31)

    spread = int(phrases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return phrases.repartition(spread, "key").sortWithinPartitions("key").mapInArrow(run, SPANS_OF)


def _spans(doc, text_hash, at, n, times, period) -> pa.RecordBatch:
    """Spans of n windows, each as often as its phrase stands in a row."""
    turn = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    doc, text_hash, at, n, period = (np.repeat(x, times) for x in (doc, text_hash, at, n, period))
    return _batch(SPANS_OF, doc, text_hash, (at + turn * period).astype(np.int32), n.astype(np.int64))


def repeated_windows(windows: DataFrame) -> DataFrame:
    """Windows of hot triggers that a smaller document has; sorted by their bytes, so the first of equal ones keeps them."""

    def run(batches):
        held, least = None, 0
        for batch in batches:
            body = np.array(batch.column(5).to_pylist(), f"S{WINDOW}")
            doc, text_hash, at, shape = (batch.column(c).to_numpy() for c in range(1, 5))
            new = np.r_[body[0] != held, body[1:] != body[:-1]]
            firsts = np.where(new, doc, least)
            first = firsts[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
            held, least = body[-1], first[-1]
            keep = np.flatnonzero(doc > first)
            if len(keep):
                yield _spans(doc[keep], text_hash[keep], at[keep], np.ones(len(keep), np.int64), shape[keep] >> 10, shape[keep] & 31)

    spread = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return windows.repartition(spread, "key").sortWithinPartitions("key", "body", "doc").mapInArrow(run, SPANS_OF)


def repeat_marks(df: DataFrame) -> DataFrame:
    """(doc, text_hash, spans): windows of ``df`` (doc, text_hash, text) that a smaller document has, as (at, windows)."""
    marks = materialize(settle(parse(df)), "repeat-marks")
    phrases = materialize(dictionary(df, marks), "repeat-dictionary")
    single = (F.col("shape").bitwiseAND(31 << 5)) == 0
    more = materialize(repeated_in_phrases(phrases.filter(~single)).unionByName(repeated_windows(phrases.filter(single))), "repeat-windows")
    windows = F.when(F.col("shape") < 0, -F.col("shape")).otherwise(F.shiftright("shape", 10) * F.shiftright("shape", 5).bitwiseAND(31))
    whole = marks.filter("whole").select("doc", "text_hash", "at", windows.alias("windows"))
    return whole.unionByName(more).groupBy("doc", "text_hash").agg(F.collect_list(F.struct("at", "windows")).alias("spans"))


def removed_spans(spans) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes (start, stop) of windows given as (at, windows)."""
    out: list[list[int]] = []
    for at, stop in sorted((m["at"], m["at"] + m["windows"] + WINDOW - 1) for m in spans or ()):
        if out and at <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([at, stop])
    return [(a, b) for a, b in out]


def whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans without the bytes of characters that are only in part covered."""
    out = []
    for a, b in spans:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for s in spans for x in s), len(raw)]
    return b"".join(raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))


def with_marks(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with a last column of spans (SPANS, or that lengthened where ``df`` has it), null where nothing is repeated."""
    doc, body = F.coalesce(F.col(key).cast("long"), F.lit(LOWEST)), F.coalesce(F.col(text), F.lit(""))
    marks = repeat_marks(df.select(doc.alias("doc"), F.xxhash64(body).alias("text_hash"), body.alias("text")))
    marked, hashed, spans = (fresh_name(df, c) for c in ("repeat_doc", "repeat_hash", SPANS))
    marks = marks.withColumnsRenamed({"doc": marked, "text_hash": hashed, "spans": spans}).hint("merge")
    return df.join(marks, (doc == F.col(marked)) & (F.xxhash64(body) == F.col(hashed)), "left").select(*[df[c] for c in df.columns], spans)


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with its texts cut; characters are kept whole. Rows whose text was all repeated keep an empty one."""
    schema = df.schema
    at = df.columns.index(text)

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                b = batch.slice(k, 256)
                texts = b.column(at).to_pylist()
                for i, spans in enumerate(b.column(b.num_columns - 1).to_pylist()):
                    if spans:
                        raw = texts[i].encode("utf-8", "surrogatepass")
                        texts[i] = without(raw, whole_characters(raw, removed_spans(spans))).decode("utf-8", "surrogatepass")
                columns = [pa.array(texts, pa.string()) if c == at else b.column(c) for c in range(b.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(columns, b.schema.names[:-1])

    return with_marks(df, key, text).mapInArrow(run, schema)


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def op6_prefix_free_parsing(spark, sf_dir):
    marked = with_marks(documents(spark, sf_dir).select("doc_id", "text"))

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                b = batch.slice(k, 256)
                rows = []
                for raw, marks in zip(_raw(b.column(1).to_pylist()), b.column(2).to_pylist(), strict=True):
                    spans = removed_spans(marks)
                    rows.append((len(raw), sum(y - x for x, y in spans), len(spans), hashlib.sha256(without(raw, spans)).hexdigest()))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3])], [c.split()[0] for c in REMOVED.split(", ")])

    return marked.mapInArrow(run, REMOVED)
