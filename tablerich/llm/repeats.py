"""Find windows that repeat across documents, exactly, whatever the size of the corpus.

A text is a row of units (bytes, or words), a window is ``window`` of them in a row. A window of a document counts as
repeated if the same window also starts in a document with a smaller ``doc_id``.

Not every suffix of the corpus is sorted. Of the ``gram``-unit buckets that begin inside a window the one with
the least hash stands for it, and windows next to each other that share it form a run. Equal windows have
the same bucket at the same place, so

1. every document sends the hashes of its buckets, once each, to be counted; a hash that only one document
   has cannot be part of a repeated window, and its windows are settled;
2. for the other buckets the text of the run goes to the task that owns the bucket, where all windows of a
   bucket meet and are told apart by their units (``classify``, the operator's own method). A bucket with very
   many runs is split: its windows go, each by itself, to the task that owns the hash of the whole window;
3. what repeats goes back to its document, where covered units are removed.

Hashes only choose what is compared; the comparison is of the units themselves. Copies met in one task are
reduced to one before they are shuffled, in step 1 by hash and in step 2 by text, so a passage that a third
of all documents share is sent once by each task. Arrays travel as compressed blocks. Texts are shuffled
compressed, and nothing but counts passes the driver.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

#: Units handled at once; positions within a step fit 24 bits.
STEP = 1 << 20
#: Hashes, and bytes of text, that a task holds before it sends them.
FLUSH_HASHES = 1 << 21
FLUSH_BYTES = 16 << 20
FLUSH_RUNS = 64 << 20
#: Bytes a run takes besides its text, and bytes of single windows at once.
RUN_BYTES = 120
WINDOWS = 16 << 20
#: Runs of a bucket from which its windows are dealt out by their own hash.
HOT_RUNS = 1 << 14
#: Bytes of text for which there is a part at least.
PART_BYTES = 32 << 20
#: The order of a document without an identifier: after all others.
NO_ID = (1 << 63) - 1
_PLACE = np.uint64((1 << 24) - 1)
_RESIDUE = np.uint64((1 << 40) - 1)
ROW = "kind int, key int, block binary"
_ROW = pa.schema([("kind", pa.int32()), ("key", pa.int32()), ("block", pa.binary())])
# What a row holds.
HASHES, VERDICT, TEXTS, RUNS, RESULT, HOT = range(6)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _pack(*parts) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(parts, protocol=5))


def _unpack(block: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(block))


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ROW.types)], schema=_ROW)


class Bytes:
    """Texts as UTF-8 bytes."""

    def __init__(self, window: int, gram: int):
        if not 8 <= gram <= window:
            raise ValueError("a bucket has 8 bytes at least and fits a window")
        self.window, self.gram = window, gram

    def units(self, raw: bytes) -> tuple[bytes, int]:
        return raw, len(raw)

    def runs(self, pieces: list[bytes], piece: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[bytes]:
        """The texts of units ``a`` to ``b`` of these pieces."""
        return [pieces[p][i:j] for p, i, j in zip(piece.tolist(), a.tolist(), b.tolist())]

    def windows(self, text: bytes, n: int) -> list[bytes]:
        return [text[i : i + self.window] for i in range(n)]

    def buckets(self, pieces: list[bytes]) -> np.ndarray:
        """Hashes of the bucket that begins at each unit of the pieces in a row; those that cross a piece are void."""
        raw = b"".join(pieces)
        n = len(raw)
        raw += bytes(self.gram + 16 - n % 8)
        words = np.empty(len(raw) // 8 * 8 - 8, np.uint64)
        for i in range(8):
            words[i::8] = np.frombuffer(raw, "<u8", len(words[i::8]), i)
        words = _mix(words)
        found = words[:n].copy()
        for at in [*range(8, self.gram - 7, 8), *([self.gram - 8] if self.gram % 8 else [])]:
            found = _mix(found ^ words[at : at + n])
        return found

    def kept(self, units: bytes, removed: np.ndarray) -> bytes:
        return np.frombuffer(units, np.uint8)[~removed].tobytes()


class Words:
    """Texts as words between white space; words are kept as bytes."""

    def __init__(self, window: int, gram: int):
        self.window, self.gram = window, gram

    def units(self, raw: bytes) -> tuple[list[bytes], int]:
        words = raw.split()
        return words, len(words)

    def runs(self, pieces: list[list[bytes]], piece: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[bytes]:
        """The texts of units ``a`` to ``b`` of these pieces."""
        out: list[bytes] = []
        cuts = np.flatnonzero(np.append(True, piece[1:] != piece[:-1])[: len(piece)])
        for i, j in zip(cuts.tolist(), np.append(cuts[1:], len(piece)).tolist()):
            words = pieces[int(piece[i])]
            raw = b" ".join(words)
            at = np.append(0, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1))
            out += [raw[x:y] for x, y in zip(at[a[i:j]].tolist(), (at[b[i:j]] - 1).tolist())]
        return out

    def windows(self, text: bytes, n: int) -> list[bytes]:
        words = text.split(b" ")
        return [b" ".join(words[i : i + self.window]) for i in range(n)]

    def buckets(self, pieces: list[list[bytes]]) -> np.ndarray:
        digest = xxhash.xxh3_64_intdigest
        codes = np.fromiter((digest(w) for p in pieces for w in p), np.uint64)
        n = len(codes)
        codes = np.concatenate([codes, np.zeros(self.gram, np.uint64)])
        found = codes[:n].copy()
        for at in range(1, self.gram):
            found = _mix(found ^ codes[at : at + n])
        return found

    def kept(self, units: list[bytes], removed: np.ndarray) -> bytes:
        return b" ".join([w for w, r in zip(units, removed.tolist()) if not r])


Units = Bytes | Words


@dataclass
class Runs:
    """Runs of windows: the piece, first window, number of windows, place of the bucket in the first one, and its hash."""

    piece: np.ndarray
    first: np.ndarray
    windows: np.ndarray
    place: np.ndarray
    hash: np.ndarray


def runs_of(units: Units, pieces: list, sizes: np.ndarray) -> Runs:
    """The runs of some pieces of text, below 2 ** 24 units together."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    span = units.window - units.gram + 1
    found = units.buckets(pieces)
    least = (found & ~_PLACE) | np.arange(total, dtype=np.uint64)
    reach = 1
    while reach < span:
        more = min(reach, span - reach)
        if more < len(least):
            np.minimum(least[:-more], least[more:], out=least[:-more])
        reach += more
    # Windows that end inside their piece.
    counts = np.maximum(0, sizes - units.window + 1)
    owner = np.repeat(np.arange(len(sizes)), counts)
    begin = ends - sizes
    window = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + begin[owner]
    bucket = (least[window] & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1])])[: len(bucket)])
    last = np.append(first[1:], len(bucket))
    return Runs(owner[first], window[first] - begin[owner[first]], last - first, bucket[first] - window[first], _mix(found[bucket[first]]))


def _segments(units: Units, documents: list[tuple]) -> Iterator[tuple[list, list, np.ndarray, np.ndarray]]:
    """Steps of documents ``(owner, units, n)``: pieces, owners, sizes, and where each piece begins in its document."""
    pieces, owners, sizes, begins, held = [], [], [], [], 0
    for owner, text, n in documents:
        for begin in range(0, max(1, n - units.window + 1), STEP):
            end = min(n, begin + STEP + units.window - 1)
            pieces.append(text[begin:end])
            owners.append(owner)
            sizes.append(end - begin)
            begins.append(begin)
            held += end - begin
            if held >= STEP:
                yield pieces, owners, np.array(sizes), np.array(begins)
                pieces, owners, sizes, begins, held = [], [], [], [], 0
    if pieces:
        yield pieces, owners, np.array(sizes), np.array(begins)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    for doc, text in zip(batch.column("doc"), batch.column("text")):
        yield doc.as_py(), (text.as_py() or "").encode()


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _part_of(docs: np.ndarray, parts: int) -> np.ndarray:
    return (_mix(docs.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)


def _split(keys: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """The columns cut by key."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    columns = [c[order] for c in columns]
    for a, b in zip(cuts, np.append(cuts[1:], len(keys))):
        yield int(keys[a]), *(c[a:b] for c in columns)


def _shared(hashes: np.ndarray, docs: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which ``(hash, doc)``, in order of both, have a hash that another document has or that is known to be shared."""
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)])
    if not len(first):
        return np.zeros(0, bool)
    size = np.diff(np.append(first, len(hashes)))
    many = np.maximum.reduceat(docs, first) != np.minimum.reduceat(docs, first)
    return np.repeat(many | np.logical_or.reduceat(known, first), size)


def _send_hashes(units: Units, parts: int) -> Callable:
    """Step 1, documents: their hashes to buckets, and what is known to be shared already."""

    def flush(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        hashes, docs = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((docs, hashes))
        hashes, docs = hashes[order], docs[order]
        first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)])
        often = np.diff(np.append(first, len(hashes))).astype(np.uint32)
        once = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])])[: len(hashes)]
        hashes, docs = hashes[once], docs[once]
        shared = _shared(hashes, docs, np.zeros(len(hashes), bool))
        rows = []
        for part, hashes_ in _split(_part_of(docs[shared], parts), hashes[shared]):
            rows.append((VERDICT, part, _pack(np.unique(_key(hashes_, parts)))))
        # A shared hash is sent once, without a document.
        again = np.concatenate([[False], hashes[1:] == hashes[:-1]])[: len(hashes)]
        hashes, docs, shared = hashes[~again], docs[~again], shared[~again]
        order = np.argsort(docs, kind="stable")
        hashes, docs, shared, often = hashes[order], docs[order], shared[order], often[order]
        for bucket, h, d, s, n in _split(_bucket_of(hashes, parts), hashes, docs, shared, often):
            residue = (h & _RESIDUE).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].copy()
            rows.append((HASHES, bucket, _pack(residue, np.diff(d, prepend=0), np.packbits(s), n)))
        return _rows(rows)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            documents = ((doc, *units.units(raw)) for doc, raw in _texts(batch))
            for pieces, owners, sizes, _ in _segments(units, documents):
                found = runs_of(units, pieces, sizes)
                held.append((found.hash, np.array(owners, np.int64)[found.piece]))
                size += len(found.hash)
                if size >= FLUSH_HASHES:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    return scan


def _key(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and residue: what is known of a hash once it has been sent."""
    return (_bucket_of(hashes, buckets).astype(np.uint64) << np.uint64(40)) | (hashes & _RESIDUE)


def _find_shared(parts: int, hot_runs: int) -> Callable:
    """Step 1, buckets: hashes of several documents back to the parts their documents are in; those of many runs to all parts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, list[bytes]] = {}
        for batch in batches:
            passed = []
            for kind, key, block in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if kind == HASHES:
                    blocks.setdefault(key, []).append(block)
                else:
                    passed.append((kind, key, block))
            if passed:
                yield _rows(passed)
        hot = []
        for bucket, found in blocks.items():
            hashes, docs, known, often = [], [], [], []
            for block in found:
                residue, delta, shared, runs = _unpack(block)
                wide = np.zeros((len(residue), 8), np.uint8)
                wide[:, :5] = residue
                hashes.append(wide.view("<u8").ravel())
                docs.append(np.cumsum(delta))
                known.append(np.unpackbits(shared, count=len(residue)).astype(bool))
                often.append(runs.astype(np.int64))
            hashes, docs, known, often = (np.concatenate(c) for c in (hashes, docs, known, often))
            order = np.lexsort((docs, hashes))
            hashes, docs, known, often = hashes[order], docs[order], known[order], often[order]
            shared = _shared(hashes, docs, known)
            first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(hashes)])
            many = first[shared[first] & (np.add.reduceat(often, first) >= hot_runs)]
            hot.append(hashes[many] | (np.uint64(bucket) << np.uint64(40)))
            wanted = shared & ~known
            # One answer for each part.
            keys = hashes[wanted] | (np.uint64(bucket) << np.uint64(40))
            rows = [(VERDICT, part, _pack(np.unique(k))) for part, k in _split(_part_of(docs[wanted], parts), keys)]
            if rows:
                yield _rows(rows)
        # There are at most as many of them as runs / ``hot_runs``, which is no less than the parts.
        if sum(map(len, hot)):
            block = _pack(np.concatenate(hot))
            yield _rows([(HOT, part, block) for part in range(parts)])

    return scan


def _send_texts(parts: int) -> Callable:
    """Documents to their parts, in compressed blocks."""

    def flush(held: list[tuple[int, bytes]]) -> pa.RecordBatch:
        by_part: dict[int, list[tuple[int, bytes]]] = {}
        for part, row in zip(_part_of(np.array([h[0] for h in held], np.int64), parts).tolist(), held):
            by_part.setdefault(part, []).append(row)
        return _rows([(TEXTS, part, _pack(rows)) for part, rows in by_part.items()])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in _texts(batch):
                held.append(row)
                size += len(row[1])
                if size >= FLUSH_BYTES:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return scan


def _text_id(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw)


#: What is known of a run: key of its bucket, place of the bucket in the first window, document, id of its text, first window, windows.
_RUN = {"key": np.uint64, "place": np.int64, "doc": np.int64, "name": np.uint64, "first": np.int64, "windows": np.int64}


class Table:
    """Runs as columns, and the text of each."""

    def __init__(self, columns: dict[str, np.ndarray], texts: list[bytes]):
        self.columns, self.texts = columns, texts

    @classmethod
    def joined(cls, tables: list[Table]) -> Table:
        columns = {c: np.concatenate([t.columns[c] for t in tables]) for c in _RUN}
        return cls(columns, [text for t in tables for text in t.texts])

    def __len__(self) -> int:
        return len(self.texts)

    def __getitem__(self, name: str) -> np.ndarray:
        return self.columns[name]

    def take(self, rows: np.ndarray) -> Table:
        return Table({c: v[rows] for c, v in self.columns.items()}, list(map(self.texts.__getitem__, rows.tolist())))

    def results(self, rows: np.ndarray) -> list[np.ndarray]:
        return [self[c][rows] for c in ("doc", "name", "first", "windows")]

    def grouped(self) -> tuple[Table, np.ndarray]:
        """Runs of equal key, place and text next to each other, each group by document; and where groups begin."""
        mark = np.fromiter(map(_text_id, self.texts), np.uint64, len(self))
        mark = _mix(mark ^ _mix(self["key"] + self["place"].astype(np.uint64)))
        found = self.take(np.lexsort((self["doc"], mark)))
        mark = np.sort(mark)
        same = np.append(False, mark[1:] == mark[:-1])[: len(mark)]
        at = np.flatnonzero(same)
        # Texts of one mark are compared; a chance meeting begins a group of its own.
        equal = np.fromiter((found.texts[i] == found.texts[i - 1] for i in at.tolist()), bool, len(at))
        for c in ("key", "place"):
            equal &= found[c][at] == found[c][at - 1]
        same[at] = equal
        return found, np.flatnonzero(~same)

    def reduced(self) -> tuple[Table, np.ndarray, list[np.ndarray]]:
        """Of equal runs those of the first document, where groups begin, and the results of all others."""
        found, begin = self.grouped()
        size = np.diff(np.append(begin, len(found)))
        later = found["doc"] > np.repeat(found["doc"][begin], size)
        settled = found.results(np.flatnonzero(later))
        if later.any():
            number = np.repeat(np.arange(len(begin)), size)[~later]
            found = found.take(np.flatnonzero(~later))
            begin = np.searchsorted(number, np.arange(len(begin)))
        return found, begin, settled


def _send_runs(units: Units, parts: int) -> Callable:
    """Step 2, documents: the runs of shared hashes to their buckets, each text once; its copies are settled."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, blocks, hot = [], [], [np.zeros(0, np.uint64)]
        for batch in batches:
            for kind, block in zip(batch.column("kind").to_pylist(), batch.column("block")):
                if kind == VERDICT:
                    wanted.append(_unpack(block.as_py())[0])
                elif kind == HOT:
                    hot.append(_unpack(block.as_py())[0])
                else:
                    blocks.append(block.as_py())
        if not wanted:
            return
        keys, hot = np.unique(np.concatenate(wanted)), np.unique(np.concatenate(hot))
        del wanted
        held: list[Table] = []
        size = 0
        while blocks:
            texts = _unpack(blocks.pop())[0]
            documents = [(i, *units.units(raw)) for i, (_, raw) in enumerate(texts)]
            docs = np.array([doc for doc, _ in texts], np.int64)
            names = np.fromiter((_text_id(raw) for _, raw in texts), np.uint64, len(texts))
            for pieces, owners, sizes, begins in _segments(units, documents):
                found = runs_of(units, pieces, sizes)
                key = _key(found.hash, parts)
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = np.flatnonzero(keys[at] == key)
                piece, first, windows = found.piece[hit], found.first[hit], found.windows[hit]
                owner = np.array(owners, np.int64)[piece]
                columns = {"key": key[hit], "place": found.place[hit], "doc": docs[owner], "name": names[owner], "first": begins[piece] + first, "windows": windows}
                run = units.runs(pieces, piece, first, first + windows + units.window - 1)
                held.append(Table(columns, run))
                size += sum(map(len, run)) + RUN_BYTES * len(run)
                if size >= FLUSH_RUNS:
                    yield from _flush_runs(units, Table.joined(held), parts, hot)
                    held, size = [], 0
        if held:
            yield from _flush_runs(units, Table.joined(held), parts, hot)

    return scan


def _flush_runs(units: Units, runs: Table, parts: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    # The first document speaks for all of its rows: it may repeat a passage, or be a repeated row.
    runs, begin, settled = runs.reduced()
    yield from _results(settled, parts)
    split = np.isin(runs["key"], hot)
    if split.any():
        whole, runs = runs.take(np.flatnonzero(split)), runs.take(np.flatnonzero(~split))
        group = np.cumsum(np.isin(np.arange(len(split)), begin))[~split]
        begin = np.flatnonzero(np.append(True, group[1:] != group[:-1])[: len(group)])
        step = max(1, WINDOWS // units.window)
        # Windows of hot buckets by themselves, some runs at a time.
        ends = np.cumsum(whole["windows"])
        cuts = np.unique(np.append(np.searchsorted(ends, np.arange(step, int(ends[-1]), step)) + 1, len(whole)))
        for a, b in zip(np.append(0, cuts[:-1]).tolist(), cuts.tolist()):
            alone, first, results = _windows(units, whole.take(np.arange(a, b)), parts).reduced()
            yield from _results(results, parts)
            yield from _packed(alone, first)
    yield from _packed(runs, begin)


def _windows(units: Units, runs: Table, parts: int) -> Table:
    """Each window of the runs as a run of its own, in the bucket of its whole text."""
    n = runs["windows"]
    texts = [w for text, k in zip(runs.texts, n.tolist()) for w in units.windows(text, k)]
    row = np.repeat(np.arange(len(runs)), n)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    key = _key(np.fromiter(map(_text_id, texts), np.uint64, len(texts)), parts)
    zero = np.zeros(len(row), np.int64)
    return Table({"key": key, "place": zero, "doc": runs["doc"][row], "name": runs["name"][row], "first": runs["first"][row] + inside, "windows": zero + 1}, texts)


def _packed(runs: Table, begin: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Runs to their buckets by column, a text once for each group: neighbours in a column are alike and compress well."""
    if not len(begin):
        return
    size = np.diff(np.append(begin, len(runs)))
    bucket = (runs["key"][begin] >> np.uint64(40)).astype(np.int64)
    out = []
    for part, groups in _split(bucket, np.arange(len(begin))):
        groups = groups[np.argsort(runs["key"][begin[groups]], kind="stable")]
        head, counts = begin[groups], size[groups]
        rows = np.repeat(head - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        owner = np.unique(np.rec.fromarrays([runs["doc"][rows], runs["name"][rows]]), return_inverse=True)
        texts = list(map(runs.texts.__getitem__, head.tolist()))
        out.append((RUNS, part, _pack(
            np.diff(runs["key"][head], prepend=np.uint64(0)), runs["place"][head].astype(np.uint16), np.fromiter(map(len, texts), np.uint32, len(texts)),
            counts.astype(np.uint32), np.diff(owner[0].f0, prepend=0), np.ascontiguousarray(owner[0].f1), owner[1].astype(np.uint32), runs["first"][rows],
            runs["windows"][head].astype(np.uint32), b"".join(texts),
        )))
        if len(out) >= 64:
            yield _rows(out)
            out = []
    if out:
        yield _rows(out)


def _unpacked(block: bytes) -> Table:
    """The rows of a block; those of a group share the object of their text."""
    keys, places, sizes, counts, docs, names, owner, first, windows, raw = _unpack(block)
    docs = np.cumsum(docs)
    ends = np.cumsum(sizes, dtype=np.int64)
    texts = [raw[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist())]
    group = np.repeat(np.arange(len(counts)), counts)
    columns = {"key": np.cumsum(keys, dtype=np.uint64)[group], "place": places[group].astype(np.int64), "doc": docs[owner], "name": names[owner],
               "first": first, "windows": windows[group].astype(np.int64)}
    return Table(columns, list(map(texts.__getitem__, group.tolist())))


def _results(columns: list[np.ndarray], parts: int) -> Iterator[pa.RecordBatch]:
    """Repeated windows, by document, text id, first and count, to the parts of their documents."""
    if len(columns[0]):
        yield _rows([(RESULT, part, _pack(*c)) for part, *c in _split(_part_of(columns[0], parts), *columns)])


def _settle_runs(units: Units, classify: Callable, parts: int) -> Callable:
    """Step 2, buckets: windows of a bucket are told apart, repeated ones are reported."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, list[bytes]] = {}
        for batch in batches:
            passed = []
            for kind, key, block in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if kind == RUNS:
                    blocks.setdefault(key, []).append(block)
                else:
                    passed.append((kind, key, block))
            if passed:
                yield _rows(passed)
        while blocks:
            _, found = blocks.popitem()
            yield from _settle_bucket(units, classify, parts, found)

    return scan


def _settle_bucket(units: Units, classify: Callable, parts: int, blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
    runs, begin, settled = Table.joined([_unpacked(b) for b in blocks]).reduced()
    yield from _results(settled, parts)
    # Groups of one key next to each other.
    order = np.argsort(runs["key"][begin], kind="stable")
    size = np.diff(np.append(begin, len(runs)))[order]
    head = begin[order]
    key, least = runs["key"][head], runs["doc"][head]
    cut = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    if not len(cut):
        return
    several = np.minimum.reduceat(least, cut) != np.maximum.reduceat(least, cut)
    groups = np.flatnonzero(np.repeat(several, np.diff(np.append(cut, len(key)))))
    if not len(groups):
        return
    head, size, key, least = head[groups], size[groups], key[groups], least[groups]
    texts = list(map(runs.texts.__getitem__, head.tolist()))
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    # Windows of one bucket meet in one step.
    ends = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
    total = np.append(0, np.cumsum(length))
    a = 0
    while a < len(key):
        b = int(ends[min(np.searchsorted(total[ends], total[a] + STEP), len(ends) - 1)])
        counts = runs["windows"][head[a:b]]
        classes = classify(texts[a:b], counts, units.window)
        owner = np.repeat(least[a:b], counts)
        low = np.full(int(classes.max()) + 1, NO_ID)
        np.minimum.at(low, classes, owner)
        later = low[classes] < owner
        # Stretches of repeated windows within a run, for every row of the run.
        start = np.cumsum(counts) - counts
        run = np.repeat(np.arange(b - a), counts)
        near = np.append(False, later[:-1] & (run[1:] == run[:-1]))
        begins = np.flatnonzero(later & ~near)
        behind = np.append(later[1:] & (run[1:] == run[:-1]), False)
        stops = np.flatnonzero(later & ~behind) + 1
        of = run[begins]
        many = size[a:b][of]
        row = np.repeat(head[a:b][of] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        at = np.repeat(begins - start[of], many)
        yield from _results([runs["doc"][row], runs["name"][row], runs["first"][row] + at, np.repeat(stops - begins, many)], parts)
        a = b


def _remove(units: Units, with_text: bool) -> Callable:
    """Step 3: units covered by repeated windows are removed."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, blocks = [], []
        for batch in batches:
            for kind, block in zip(batch.column("kind").to_pylist(), batch.column("block")):
                (found if kind == RESULT else blocks).append(block.as_py())
        columns = [np.concatenate(c) for c in zip(*map(_unpack, found))] if found else [np.zeros(0, np.int64)] * 4
        order = np.lexsort((columns[1], columns[0]))
        doc, text, first, count = (c[order] for c in columns)
        for block in blocks:
            out = []
            for name, raw in _unpack(block)[0]:
                held, n = units.units(raw)
                removed = np.zeros(n, bool)
                a, b = np.searchsorted(doc, [name, name + 1 if name < NO_ID else name], "left")
                b = len(doc) if name == NO_ID else b
                if b > a:
                    own = text[a:b] == np.uint64(_text_id(raw))
                    step = np.zeros(n + 1, np.int64)
                    np.add.at(step, first[a:b][own], 1)
                    np.add.at(step, first[a:b][own] + count[a:b][own] + units.window - 1, -1)
                    removed = np.cumsum(step)[:n] > 0
                spans = int((removed & ~np.concatenate([[False], removed[:-1]])).sum()) if n else 0
                kept = units.kept(held, removed) if spans or not isinstance(held, bytes) else held
                out.append((None if name == NO_ID else name, n, int(removed.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            names = ["doc_id", "n_units", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + with_text]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)][: len(names)], names)

    return scan


def remove_repeats(docs: DataFrame, units: Units, classify: Callable, with_text: bool = False) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_units, n_removed, n_spans, kept_sha256`` (and ``kept``, as bytes).

    ``classify(texts, counts, window)`` gives a class to each of the ``counts`` windows of each text, equal for
    equal windows only.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(
        int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.sparkSession.sparkContext.defaultParallelism,
        -(-size // PART_BYTES),
    )
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc"), "text")

    def to_key(*frames: DataFrame) -> DataFrame:
        joined = frames[0]
        for f in frames[1:]:
            joined = joined.unionByName(f)
        return joined.repartition(parts, "key")

    texts = rows.mapInArrow(_send_texts(parts), ROW)
    verdicts = to_key(rows.mapInArrow(_send_hashes(units, parts), ROW)).mapInArrow(_find_shared(parts, max(HOT_RUNS, parts)), ROW)
    runs = to_key(verdicts, texts).mapInArrow(_send_runs(units, parts), ROW)
    results = to_key(runs).mapInArrow(_settle_runs(units, classify, parts), ROW)
    schema = "doc_id bigint, n_units bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_text
    return to_key(results, texts).mapInArrow(_remove(units, with_text), schema)
