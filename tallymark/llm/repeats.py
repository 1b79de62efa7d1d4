"""Repeated byte strings across documents, by a distributed difference-cover sort.

A string of `length` bytes that starts at i and at j has a shift d below v for which i + d
and j + d both lie in a difference cover modulo v (sizes by Colbourn and Ling). So:

1. Names of the windows of length - v + 1 bytes at the cover's positions (about 1.6 / sqrt(v)
   of all) are sorted in ranges of names; equal neighbours are repeated. The rest of the
   suffixes that no repeated sample is near to are out: they need no further name.
2. The remaining suffixes, unsampled ones too, get names of their first `length` bytes, are
   merged into ranges of names in the same way, and adjacent equal prefixes are repeats.

3. Names are the leading bits of 64-bit codes (see shared.window_codes), as many as leave
   few names equal by chance, and equal ones only propose repeats. The first block that has a name keeps it; the others send it the bytes, runs of adjacent
   windows as one string, and it compares them. Strings that differ from the keeper's are
   compared with each other. Only bytes that were found equal are removed.

Suffixes are compared to `length` bytes and no further, as nothing beyond matters. There are
no sorted triples, no recursion on names and no merge of suffixes: ranks of whole suffixes
are never made.

Texts lie in compressed blocks in the shared folder, written once; a task reads the block
it needs, so only names and bitmaps are shuffled. A block sends a name once however often
it has it, so a passage that all documents share costs one name per block. Answers are
bitmaps in the order of a block's sorted names.

Passages of over 50 words are often shorter than 400 bytes. Documents that share one are
found along with that, by the same two steps over words in place of bytes and a perfect
difference set, and get the number of words covered; equal 64-bit codes count as equal
passages there, and nothing is removed for them.

Null and empty texts have no bytes and lose none; long ones are whole. Repeated rows remove
each other. An empty table gives no rows; extra columns go.
"""

from __future__ import annotations

import hashlib
import itertools
import struct
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

NAMES = "uid string, bucket int, n int, names binary, twice binary"
ANSWERS = "uid string, level int, bucket int, n int, repeated binary, keeper binary"
#: Messages to a block: its own places that are sure, those it keeps, another block's places and bytes, or its own words that begin repeated passages.
SURE, KEPT, ASKED, PASSAGE = range(4)
#: Words of a passage that is reported, and a perfect difference set for it: a modulus, and residues of which any difference is one of two.
PASSAGE_WORDS, WORD_COVER = 51, (31, np.array([1, 5, 11, 24, 25, 27]))
MESSAGES = "uid string, kind int, source string, runs binary, data binary"


def difference_cover(r: int) -> tuple[int, np.ndarray]:
    """A modulus and the cover's residues: every difference modulo it is one of two residues."""
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, np.cumsum([0, *steps])


def cover_for(length: int) -> tuple[int, np.ndarray]:
    """The largest cover that leaves samples at least half the length; below that, every position."""
    best = (1, np.array([0]))
    r = 0
    while 24 * r * r + 36 * r + 13 <= length // 2 + 1:
        best = difference_cover(r)
        r += 1
    return best


class Units:
    """Bytes or words of a block's texts in order: by unit, the first of its text and the one after its last; sums of codes."""

    def __init__(self, codes: np.ndarray, first: np.ndarray):
        self.sums = shared.prefix_sums(codes)
        sizes, kind = np.diff(first), np.int32 if len(codes) < 2**31 - 2**20 else np.int64
        self.end = np.repeat(first[1:].astype(kind), sizes)
        self.start = np.repeat(first[:-1].astype(kind), sizes)

    def sampled(self, length: int, v: int, cover: np.ndarray) -> np.ndarray:
        """Places in the cover whose window, and a whole string around it, may fit."""
        in_cover = np.zeros(v, bool)
        in_cover[cover] = True
        width = length - v + 1
        place = np.arange(len(self.start), dtype=self.start.dtype)
        return place[in_cover[(place - self.start) % v] & (place + width <= self.end) & (self.end - self.start >= length)]

    def names(self, places: np.ndarray, width: int) -> np.ndarray:
        return shared.window_codes(self.sums, places, places + width)

    def near(self, places: np.ndarray, length: int, v: int) -> np.ndarray:
        """Starts of strings that have one of the places among their first v units."""
        steps = np.zeros(len(self.start) + 1, np.int32)
        first = np.maximum(places - v + 1, self.start[places])
        last = np.minimum(places, self.end[places] - length)
        ok = first <= last
        np.add.at(steps, first[ok], 1)
        np.add.at(steps, last[ok] + 1, -1)
        return np.flatnonzero(np.cumsum(steps[:-1]) > 0)

    def covered(self, starts: np.ndarray, length: int) -> np.ndarray:
        steps = np.zeros(len(self.start) + 1, np.int32)
        steps[starts] += 1
        np.add.at(steps, starts + length, -1)
        return np.cumsum(steps[:-1]) > 0


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Block:
    """Texts of some rows: bytes, offsets, and doc_ids."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, doc_ids: list):
        self.data, self.offsets, self.doc_ids = data, offsets, doc_ids

    @cached_property
    def bytes(self) -> Units:
        return Units(shared.BYTE_CODES[self.data], self.offsets)

    @cached_property
    def words(self) -> Units:
        """Runs of other bytes than ASCII white space; first_words has the first of each text, and their number."""
        word, edge = ~_SPACE[self.data], np.zeros(len(self.data) + 1, bool)
        edge[self.offsets] = True
        starts = np.flatnonzero(word & (~np.concatenate([[False], word])[:-1] | edge[:-1]))
        ends = np.flatnonzero(word & (~np.concatenate([word, [False]])[1:] | edge[1:])) + 1
        self.first_words = np.searchsorted(starts, self.offsets)
        return Units(shared.word_codes(self.data, starts, ends), self.first_words)

    @staticmethod
    def write(fs, path: str, parts: list[tuple[np.ndarray, np.ndarray, list]]) -> None:
        data = b"".join(d.tobytes() for d, _, _ in parts)
        sizes = np.concatenate([np.diff(o) for _, o, _ in parts]).astype("<i8")
        ids = [i for _, _, x in parts for i in x]
        valid = np.array([i is not None for i in ids], np.uint8)
        raw = struct.pack("<Q", len(ids)) + sizes.tobytes() + valid.tobytes() + np.array([i or 0 for i in ids], "<i8").tobytes() + data
        with fs.open_output_stream(path, compression=None) as out:
            out.write(zstandard.ZstdCompressor(level=3).compress(raw))

    @classmethod
    def read(cls, fs, path: str) -> Block:
        with fs.open_input_stream(path, compression=None) as f:
            raw = zstandard.ZstdDecompressor().decompress(f.read())
        n = struct.unpack_from("<Q", raw)[0]
        sizes = np.frombuffer(raw, "<i8", n, 8)
        valid = np.frombuffer(raw, np.uint8, n, 8 + 8 * n)
        ids = [int(i) if ok else None for i, ok in zip(np.frombuffer(raw, "<i8", n, 8 + 9 * n), valid)]
        return cls(np.frombuffer(raw, np.uint8, offset=8 + 17 * n), np.concatenate([[0], np.cumsum(sizes)]), ids)


def pack(names: np.ndarray) -> bytes:
    """Sorted names as differences, byte planes apart, so that the shuffle's codec shortens the high ones."""
    steps = np.diff(names, prepend=np.uint64(0))
    return steps.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def bucket_of(names: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of names of equal size."""
    return ((names >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def is_in(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.searchsorted(sorted_set, values)
    at[at == len(sorted_set)] = 0
    return sorted_set[at] == values


def ranks(values: np.ndarray) -> np.ndarray:
    """The index of each value among the sorted distinct ones. One sort is faster than a search for each in a long array."""
    order = np.argsort(values)
    ordered = values[order]
    out = np.empty(len(values), np.int64)
    out[order] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]])) if len(values) else 0
    return out


def runs_of(places: np.ndarray, *keys: tuple[np.ndarray, int]) -> tuple[np.ndarray, np.ndarray]:
    """Index and size of each run of adjacent places, in order, along which each key grows by its step."""
    if not len(places):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.diff(places) != 1
    for k, step in keys:
        new |= np.diff(k) != step
    at = np.concatenate([[0], np.flatnonzero(new) + 1])
    return at, np.diff(np.append(at, len(places)))


def pack_runs(places: np.ndarray) -> bytes:
    at, sizes = runs_of(places)
    return np.concatenate([places[at], sizes]).astype("<i8").tobytes()


def unpack_runs(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(raw, "<i8").reshape(2, -1))


def spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of runs."""
    return np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def equal_windows(x: np.ndarray, a: np.ndarray, y: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether x has the same bytes from each place of a as y from that of b."""
    out = np.ones(len(a), bool)
    for k, n in zip(*(r.tolist() for r in runs_of(a, (b, 1)))):
        left, right = x[a[k] : a[k] + n + length - 1], y[b[k] : b[k] + n + length - 1]
        if left.tobytes() != right.tobytes():
            wrong = np.concatenate([[0], np.cumsum(left != right)])
            out[k : k + n] = wrong[length:] == wrong[:n]
    return out


def first_equal(data: np.ndarray, places: np.ndarray, names: np.ndarray, length: int) -> np.ndarray:
    """For each place, the index of the first one with the same bytes; names only save comparisons."""
    rank = ranks(names)
    out = np.full(rank.max(initial=-1) + 1, len(names))
    np.minimum.at(out, rank, np.arange(len(names)))
    out = out[rank]
    later = np.flatnonzero(out != np.arange(len(places)))
    seen = {}
    for k in later[~equal_windows(data, places[later], data, places[out[later]], length)].tolist():
        out[k] = seen.setdefault(data[places[k] : places[k] + length].tobytes(), k)
    return out


def _send(uid: str, names: np.ndarray, shift: int, buckets: int, texts: np.ndarray | None = None):
    """Rows of NAMES: a block's distinct names, which lack the last shift bits, and which it has twice, by bucket.

    With texts, the text that each name is of, twice is in two of them; buckets are numbered on, as these are other names.
    """
    if texts is None:
        ordered = np.sort(names)
        at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
        every, twice = ordered[at], np.diff(np.append(at, len(ordered))) > 1
    else:
        order = np.argsort(names, kind="stable")
        at = np.flatnonzero(np.diff(names[order], prepend=~names[order[:1]]) != 0)
        every, of = names[order[at]], texts[order]
        twice = np.minimum.reduceat(of, at) != np.maximum.reduceat(of, at) if len(at) else np.zeros(0, bool)
    cuts = np.searchsorted(bucket_of(every << np.uint64(shift), buckets), np.arange(buckets + 1))
    start = 0 if texts is None else buckets
    rows = [(uid, start + b, int(z - a), pack(every[a:z]), np.packbits(twice[a:z]).tobytes()) for b, (a, z) in enumerate(zip(cuts[:-1], cuts[1:])) if z > a]
    for at in range(0, len(rows), 64):
        cols = list(zip(*rows[at : at + 64]))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["uid", "bucket", "n", "names", "twice"])


def _answers(sent: DataFrame, level: int, tasks: int) -> DataFrame:
    """For each block and bucket, a bit for each name: whether any other place has it; and who keeps those that are."""

    def merge(group: pa.Table) -> pa.Table:
        each = [unpack(x.as_py()) for x in group.column("names")]
        twice = [np.unpackbits(np.frombuffer(t.as_py(), np.uint8), count=len(x)).astype(bool) for t, x in zip(group.column("twice"), each)]
        every = np.sort(np.concatenate(each))
        repeated = shared.distinct(np.concatenate([every[1:][every[1:] == every[:-1]], *[x[t] for x, t in zip(each, twice)]]))
        hits = [is_in(x, repeated) for x in each]
        bits = [np.packbits(h).tobytes() for h in hits]
        n = len(each)
        keepers = [None] * n
        if level == 2:
            numbers = [int(u, 16) for u in group.column("uid").to_pylist()]
            at = [np.searchsorted(repeated, x[h]) for x, h in zip(each, hits)]
            keeper = np.zeros(len(repeated), np.int64)
            for k in sorted(range(n), key=numbers.__getitem__, reverse=True):
                keeper[at[k]] = numbers[k]
            keepers = [pack_keepers(keeper[k]) for k in at]
        cols = [group.column("uid"), pa.array([level] * n, pa.int32()), group.column("bucket"), group.column("n"), pa.array(bits, pa.binary()), pa.array(keepers, pa.binary())]
        return pa.table(cols, names=["uid", "level", "bucket", "n", "repeated", "keeper"])

    return sent.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(merge, ANSWERS)


def pack_keepers(keepers: np.ndarray) -> bytes:
    who, which = np.unique(keepers, return_inverse=True)
    width = 1 if len(who) <= 1 << 8 else 2 if len(who) <= 1 << 16 else 4
    return struct.pack("<QQ", len(who), width) + who.astype("<i8").tobytes() + which.astype(f"<u{width}").tobytes()


def unpack_keepers(raw: bytes) -> np.ndarray:
    n, width = struct.unpack_from("<QQ", raw)
    return np.frombuffer(raw, "<i8", n, 16)[np.frombuffer(raw, f"<u{width}", offset=16 + 8 * n)] if n else np.empty(0, np.int64)


def _messages(rows: list[tuple]) -> pa.Table:
    kinds = (pa.string(), pa.int32(), pa.string(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 5, kinds)], names=["uid", "kind", "source", "runs", "data"])


def _repeated(names: np.ndarray, answers: list) -> np.ndarray:
    """Which of a block's names are repeated, by the answers (bucket, n, bits, keepers) to its distinct names."""
    bits = [np.unpackbits(np.frombuffer(r, np.uint8), count=n) for _, n, r, _ in sorted(answers)]
    return np.concatenate(bits).astype(bool)[ranks(names)] if bits else np.zeros(len(names), bool)


def remove_repeats(docs: DataFrame, length: int = 400, block_bytes: int = 4 << 20, text: bool = False, words: int = PASSAGE_WORDS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_words of every row; with text, kept (binary) too.

    A byte is removed if a string of length bytes that also starts elsewhere covers it. A word
    counts for n_passage_words if a passage of that many words that another document also has
    covers it, of however many bytes; nothing is removed for that.
    """
    spark = docs.sparkSession
    v, cover = cover_for(length)
    width = length - v + 1
    wv, word_cover = WORD_COVER if words > WORD_COVER[0] else (1, np.array([0]))
    path = shared.scratch(spark, "blocks")

    def write(batches):
        fs, base = pafs.FileSystem.from_uri(path)
        fs.create_dir(base, recursive=True)
        parts, size = [], 0
        numbers = itertools.count(TaskContext.get().taskAttemptId() << 24)

        def put():
            uid = f"{next(numbers):016x}"
            Block.write(fs, f"{base}/{uid}", parts)
            return pa.RecordBatch.from_arrays([pa.array([uid]), pa.array([size], pa.int64())], names=["uid", "size"])

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                data, offsets = shared.text_bytes(part.column(1))
                parts.append((data.copy(), offsets.copy(), part.column(0).to_pylist()))
                size += len(data)
                if size >= block_bytes:
                    yield put()
                    parts, size = [], 0
        if parts:
            yield put()

    rows = shared.small_batches(shared.with_columns(docs, "doc_id", "text")).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = shared.materialise(rows.mapInArrow(write, "uid string, size long"), "block-list")
    total = blocks.agg(F.sum("size"), F.count(F.lit(1))).first()
    buckets, tasks = max(64, (total[0] or 0) // (8 << 20)), max(1, total[1])
    # of names that are no proposals but equal by chance there is one in 2 ** 10, and one in 2 ** 14 of those that bytes are sent for
    bits = int(total[0] or 1).bit_length()
    cut1, cut2 = max(0, 64 - bits - 10), max(0, 64 - bits - 14)
    merges = max(1, (total[0] or 0) // (32 << 20))  # tasks that compare names, of a fixed share of the text
    # one task a block, whatever the sizes of the rows that name them
    numbered = blocks.select("uid").repartition(tasks)

    def first_level(batches):
        fs, base = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for uid in batch.column("uid").to_pylist():
                block = Block.read(fs, f"{base}/{uid}")
                yield from _send(uid, block.bytes.names(block.bytes.sampled(length, v, cover), width) >> np.uint64(cut1), cut1, buckets)
                places = block.words.sampled(words, wv, word_cover)
                yield from _send(uid, block.words.names(places, words - wv + 1) >> np.uint64(cut1), cut1, buckets, block.words.start[places])

    first = shared.materialise(_answers(numbered.mapInArrow(first_level, NAMES), 1, merges), "answers")

    def starts(block, answers):
        """The remaining suffixes of a block."""
        places = block.bytes.sampled(length, v, cover)
        return block.bytes.near(places[_repeated(block.bytes.names(places, width) >> np.uint64(cut1), answers)], length, v)

    def passages(block, answers):
        """The words of a block that may begin repeated passages."""
        places = block.words.sampled(words, wv, word_cover)
        return block.words.near(places[_repeated(block.words.names(places, words - wv + 1) >> np.uint64(cut1), answers)], words, wv)

    def by_level(group, level, of_words=False):
        rows = zip(*(group.column(k).to_pylist() for k in ("level", "bucket", "n", "repeated", "keeper")))
        return [(b, n, r, x) for k, b, n, r, x in rows if k == level and (b >= buckets) == of_words]

    def second_level(key, group):
        fs, base = pafs.FileSystem.from_uri(path)
        block = Block.read(fs, f"{base}/{key[0].as_py()}")
        places = passages(block, by_level(group, 1, True))
        sent = list(_send(key[0].as_py(), block.words.names(places, words), 0, buckets, block.words.start[places]))
        sent += _send(key[0].as_py(), block.bytes.names(starts(block, by_level(group, 1)), length) >> np.uint64(cut2), cut2, buckets)
        empty = pa.schema([("uid", pa.string()), ("bucket", pa.int32()), ("n", pa.int32()), ("names", pa.binary()), ("twice", pa.binary())])
        return pa.Table.from_batches(sent, empty)

    # a number of partitions of its own, as little shuffled data stands for much work
    second = shared.materialise(_answers(first.repartition(tasks, "uid").groupBy("uid").applyInArrow(second_level, NAMES), 2, merges), "answers")

    def ask(key, group):
        """What a block knows of its own, and the bytes that it sends to the keepers of its names."""
        fs, base = pafs.FileSystem.from_uri(path)
        uid = key[0].as_py()
        block, answers = Block.read(fs, f"{base}/{uid}"), by_level(group, 2)
        places = passages(block, by_level(group, 1, True))
        places = places[_repeated(block.words.names(places, words), by_level(group, 2, True))]
        rows = [(uid, PASSAGE, uid, pack_runs(places), b"")] if len(places) else []
        places = starts(block, by_level(group, 1))
        names = block.bytes.names(places, length) >> np.uint64(cut2)
        left = _repeated(names, answers)
        places, names = places[left], names[left]
        if not len(places):
            return _messages(rows)
        keeper = np.concatenate([unpack_keepers(x) for *_, x in sorted(answers)])[ranks(names)]
        first = first_equal(block.data, places, names, length)
        alone = first == np.arange(len(places))
        sure = np.bincount(first, minlength=len(places))[first] > 1
        rows += [(uid, SURE, uid, pack_runs(places[sure]), b""), (uid, KEPT, uid, pack_runs(places[alone & (keeper == int(uid, 16))]), b"")]
        alone &= keeper != int(uid, 16)
        places, keeper = places[alone], keeper[alone]
        at, sizes = runs_of(places, (keeper, 0))
        for who in np.unique(keeper[at]).tolist():
            of = keeper[at] == who
            data = b"".join(block.data[a : a + n + length - 1].tobytes() for a, n in zip(places[at[of]].tolist(), sizes[of].tolist()))
            rows.append((f"{who:016x}", ASKED, uid, np.concatenate([places[at[of]], sizes[of]]).astype("<i8").tobytes(), data))
        return _messages(rows)

    def compare(key, group):
        """Places that are repeats, by block, from the bytes that were sent to the keeper of their names."""
        fs, base = pafs.FileSystem.from_uri(path)
        uid = key[0].as_py()
        rows = list(zip(*(group.column(k).to_pylist() for k in ("kind", "source", "runs", "data"))))
        out = [(uid, kind, uid, runs, b"") for kind, _, runs, _ in rows if kind in (SURE, PASSAGE)]
        asked = [(source, unpack_runs(runs), np.frombuffer(data, np.uint8)) for kind, source, runs, data in rows if kind == ASKED]
        if not asked:
            return _messages(out)
        block = Block.read(fs, f"{base}/{uid}")
        kept = np.concatenate([spread(*unpack_runs(runs)) for kind, _, runs, _ in rows if kind == KEPT])
        kept_names = block.bytes.names(kept, length) >> np.uint64(cut2)
        every, first = np.unique(kept_names, return_index=True)
        found, others, other_names = np.zeros(len(kept), bool), {}, set()
        for source, (begin, sizes), data in asked:
            places, at = spread(begin, sizes), spread(np.cumsum(sizes + length - 1) - sizes - length + 1, sizes)
            names = shared.window_codes(shared.byte_sums(data), at, at + length) >> np.uint64(cut2)
            own = first[np.searchsorted(every, names)]
            same = equal_windows(data, at, block.data, kept[own], length)
            found[own[same]] = True
            out.append((source, SURE, uid, pack_runs(places[same]), b""))
            for k in np.flatnonzero(~same).tolist():
                others.setdefault(data[at[k] : at[k] + length].tobytes(), []).append((source, int(places[k])))
                other_names.add(int(names[k]))
        if others:
            for k in np.flatnonzero(np.isin(kept_names, np.array(sorted(other_names), np.uint64))).tolist():
                others.setdefault(block.data[kept[k] : kept[k] + length].tobytes(), []).append((uid, int(kept[k])))
            out += [(who, SURE, uid, pack_runs(np.array([p])), b"") for same in others.values() if len(same) > 1 for who, p in same]
        out.append((uid, SURE, uid, pack_runs(kept[found]), b""))
        return _messages(out)

    both = first.unionByName(second).repartition(tasks, "uid").groupBy("uid").applyInArrow(ask, MESSAGES)
    sure = shared.materialise(both.repartition(tasks, "uid").groupBy("uid").applyInArrow(compare, MESSAGES).select("uid", "kind", "runs"), "sure")

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words"] + ["kept"] * text
    kinds = [pa.int64()] * 4 + [pa.string(), pa.int64()] + [pa.binary()] * text

    def finish(key, group):
        fs, base = pafs.FileSystem.from_uri(path)
        block = Block.read(fs, f"{base}/{key[0].as_py()}")
        starts = {kind: [spread(*unpack_runs(runs)) for k, runs in zip(group.column("kind").to_pylist(), group.column("runs").to_pylist()) if k == kind] for kind in (SURE, PASSAGE)}
        repeated = np.zeros(len(block.data), bool)
        for places in starts[SURE]:
            repeated[places] = True
        gone = block.bytes.covered(np.flatnonzero(repeated), length)
        found = np.zeros(len(block.doc_ids), np.int64)
        if starts[PASSAGE]:
            sums = np.concatenate([[0], np.cumsum(block.words.covered(np.concatenate(starts[PASSAGE]), words))])
            found = np.diff(sums[block.first_words])
        out = []
        for doc_id, a, z, n in zip(block.doc_ids, block.offsets[:-1], block.offsets[1:], found.tolist()):
            g = gone[a:z]
            kept = block.data[a:z][~g].tobytes()
            spans = int(np.count_nonzero(np.diff(g.astype(np.int8), prepend=0) == 1)) if len(g) else 0
            out.append((doc_id, int(z - a), int(np.count_nonzero(g)), spans, hashlib.sha256(kept).hexdigest(), n) + ((kept,) if text else ()))
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    every = blocks.select("uid", F.lit(None).cast("int").alias("kind"), F.lit(None).cast("binary").alias("runs")).unionByName(sure)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passage_words long" + ", kept binary" * text
    return every.repartition(tasks, "uid").groupBy("uid").applyInArrow(finish, schema)


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(shared.table(spark, sf_dir, "documents"))
