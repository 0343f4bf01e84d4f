"""N-gram Jaccard join of whole texts with a prefix tree.

A document's set holds 64-bit hashes of its distinct word n-grams (A-Z lower-cased); all sets
share one order, that of the hashes.  Equal sets are one record.

1. Filter.  Let p = |x| - ceil(t|x|) + 1 and q = p / 2.  Two records that link share at least
   q + 1 of their first p + q n-grams (with the smaller q of the two).  A record with fewer
   n-grams that any other record has among its first ones too can't link and is its own class.
2. Groups.  Among the longer prefixes (p + 2 p n-grams) of the records left, two that link share
   as many again; in the order from the rarest n-gram to the commonest, each record without the last
   of them but one less, so they meet in one of the n-grams that remain.  Records that do form a chain;
   the chains' components are the groups.  Passages found in many texts come last in that order and
   so don't tie unrelated records together.  Pairs are never listed.
3. Join.  A group's sets are stored in a trie, the group's commonest n-grams first, each run
   of n-grams without a fork on one edge.  All records of a block go down the trie together: a
   node holds every record's overlap with the path so far, which all sets below share, and a
   subtree is left as soon as no record can reach the needed overlap with what remains below.
   A large group is cut into blocks by hash, and pairs of blocks are dealt by a hash of group and both
   blocks, so no task holds a whole group and no link is lost (a group of k blocks sends each
   of its sets to k pairs).  Of two blocks, records without a part in common with the other one stay
   out: a set is cut by a hash into more parts than two linked sets can differ in.
4. Classes.  A task returns a star for each set of records that its links connect, not the
   links; components over those stars are the classes.

An n-gram met in very many records is reduced to its smallest record before the shuffle
and joined back to narrow rows, which adaptive execution may split; nothing is ordered by it.

Little goes over the disk: the filter's n-grams and records travel packed, ten bytes a pair, with
the n-gram cut to 32 bits beside its range and the record's name to 47 (a clash only lets more
records pass or meet); texts are joined with the records that passed only where a bitmap of those is hit;
sets move once to their digest's group and once to their blocks.

Edge cases: null, empty and blank texts have an empty set, link with nothing and are their
own class; with fewer than n words the whole sequence is the one n-gram; null ids never are
a class's smallest id unless it has no other; repeated rows are documents of their own;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from daypanel.llm.common import byte_words, marked, materialise, small_batches, with_fields
from daypanel.llm.components import components

#: Prefixes that the groups come from have so many times the filter's p n-grams more.
LONGER = 2

#: So many n-grams a task gathers before it sorts them, and so many marks it holds of records against n-grams.
HELD, MARKS = 500_000, 32_000_000


def _stir(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a text."""
    words = byte_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    if len(h) < n:
        return np.array([xxh3_64_intdigest(b" ".join(words))], dtype=np.uint64)
    last = len(h) - n + 1
    x = h[:last].copy()
    for k in range(1, n):
        x = _stir(x) + h[k:k + last]
    return np.unique(_stir(x))


def first_grams(x: np.ndarray, num: int, den: int) -> np.ndarray:
    """The first p + p / 2 n-grams of a sorted set."""
    p = len(x) - -(-num * len(x) // den) + 1
    return x[:p + p // 2]


def needed(n, num: int, den: int, div=lambda a, b: a // b, least=min):
    """How many of its first n-grams a set of ``n`` shares with any set it links with.

    Two sets share at least q + 1, with the smaller of their q; the smallest set that may
    link with n n-grams has ceil(t * n).  Works on numbers, and on columns with their functions.
    """
    m = div(n * num + (den - 1), den)
    at_least = div(m * num + (den - 1), den)
    return least(div(m - at_least + 1, 2) + 1, at_least)


def longer_prefix(x: np.ndarray, num: int, den: int) -> tuple[np.ndarray, int]:
    """The first p + ``LONGER`` p n-grams of a sorted set, and how many it shares of them with any set it links with."""
    def p(n: int) -> int:
        return n - -(-num * n // den) + 1

    least = -(-num * len(x) // den)
    return x[:(1 + LONGER) * p(len(x))], min(LONGER * p(least) + 1, -(-num * least // den))


def size_classes(most: int, num: int, den: int) -> list[int]:
    """Starts of size classes up to beyond ``most``: linked sets are in the same or neighbouring ones."""
    starts = [1]
    while starts[-1] <= most:
        starts.append(starts[-1] * den // num + 1)
    return starts + [starts[-1] * den // num + 1]


def part_keys(x: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of a set's parts.  Linked sets that differ have a key in common.

    Class c's records take part in the pairs of classes (c - 1, c) and (c, c + 1).  Sets of
    such a pair differ in at most d n-grams if they link; d + 2 parts leave two equal ones.
    Empty parts count only for a set that has two of them.
    """
    starts = size_classes(len(x), num, den)
    c = len(starts) - 3
    mixed, out = _stir(x), []
    for g in (c - 1, c):
        if g < 0:
            continue
        d = (den - num) * 2 * (starts[g + 2] - 1) // (den + num)
        if d == 0:  # only equal sets link
            continue
        m = d + 2
        part = (mixed % np.uint64(m)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        begins = np.flatnonzero(np.append(True, np.diff(part[order]) > 0))
        used, sums = part[order][begins], np.add.reduceat(mixed[order], begins)
        tag = np.uint64(g * 1_000_003 + 17)
        out.append(_stir(sums * np.uint64(0xC2B2AE3D27D4EB4F) + _stir(used.astype(np.uint64) + (tag << np.uint64(24)))))
        empty = np.setdiff1d(np.arange(m), used)
        if len(empty) > 1:
            out.append(_stir(_stir(empty.astype(np.uint64) + (tag << np.uint64(24))) ^ np.uint64(0xA5A5A5A5)))
    return np.concatenate([np.zeros(0, np.uint64), *out])


def _digest(x: np.ndarray) -> bytes:
    return hashlib.blake2b(x.astype("<u8").tobytes(), digest_size=16).digest()


def _node(digest: bytes) -> int:
    """A short name (47 bits) of a record for the filter and the groups, where a clash would do no harm."""
    return int.from_bytes(digest[:8], "little") >> 17


def _values(column: pa.Array, step: int = 500) -> Iterator:
    """The values of a column, so many at a time as Python objects."""
    for k in range(0, len(column), step):
        yield from column.slice(k, step).to_pylist()


def _records(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Per document: set size, digest of the set, its short name."""
    for b in batches:
        sizes, digests = [], []
        for text in _values(b.column(1)):
            x = shingles(text, n)
            sizes.append(len(x))
            digests.append(_digest(x))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
             pa.array([_node(d) for d in digests], pa.int64())], names=[b.schema.names[0], "n_shingles", "digest", "node"])


def _first(batches: Iterator[pa.RecordBatch], n: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """(n-gram, record, n) for the first n-grams; equal sets of a partition once (see ``_resolved``)."""
    done: set[bytes] = set()
    grams, nodes, size = [], [], 0

    def rows() -> pa.RecordBatch:
        g, x = np.concatenate(grams).view(np.int64), np.concatenate(nodes)
        grams.clear()
        nodes.clear()
        return _resolved(g, x)

    for b in batches:
        for text in _values(b.column(0)):
            x = shingles(text, n)
            if len(x) and (d := _digest(x)) not in done:
                done.add(d)
                head = first_grams(x, num, den).copy()  # a view would keep the whole set
                grams.append(head)
                nodes.append(np.full(len(head), _node(d)))
                size += len(head)
            if size > HELD:
                yield rows()
                size = 0
    if grams:
        yield rows()


def _resolved(grams: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
    """Rows (gram, node, n) of n-grams and the records that have them, frequent n-grams reduced.

    An n-gram that several of these records have is known to be shared: it goes on as two witnesses
    (n = 0) only, and its records get counts of such n-grams (n < 0, under a gram of their own).
    Others (n = 1) are decided where all rows of the n-gram meet.
    """
    order = np.lexsort((nodes, grams))
    g, x = grams[order], nodes[order]
    begin = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    size = np.diff(np.append(begin, len(g)))
    several = size > 1
    first, last, known = begin[several], (begin + size - 1)[several], np.repeat(several, size)
    sure, times = np.unique(x[known], return_counts=True)
    return pa.RecordBatch.from_pydict({
        "gram": pa.array(np.concatenate([g[~known], g[first], g[first], sure])),
        "node": pa.array(np.concatenate([x[~known], x[first], x[last], sure])),
        "n": pa.array(np.concatenate([np.ones(int((~known).sum()), np.int32), np.zeros(2 * len(first), np.int32), -times.astype(np.int32)]))})


def _packed(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``_resolved`` as arrays, a row for each of 2 ** ``bits`` ranges of n-grams.

    grams: 32 bits each; names: 47 bits of the record, then whether the row counts (n = 1).  Counts
    (n < 0) are a row of their own without grams.
    """
    for b in batches:
        gram, node, n = (b.column(k).to_numpy() for k in range(3))
        mixed, names = _stir(gram.view(np.uint64)), node.astype(np.uint64)
        at = (mixed >> np.uint64(64 - bits)).astype(np.int32)
        low = (mixed >> np.uint64(32 - bits)).astype("<u4")
        rows = np.flatnonzero(n >= 0)
        rows = rows[np.argsort(at[rows], kind="stable")]
        begin = np.flatnonzero(np.diff(at[rows], prepend=-1))
        flagged = (names << np.uint64(1) | (n == 1).astype(np.uint64)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        ends = np.append(begin[1:], len(rows))
        sure = np.flatnonzero(n < 0)
        yield pa.RecordBatch.from_pydict({
            "at": pa.array([*at[rows[begin]], *at[sure[:1]]], pa.int32()),
            "grams": pa.array([*(low[rows[i:j]].tobytes() for i, j in zip(begin, ends)), *[None] * len(sure[:1])], pa.binary()),
            "names": pa.array([*(flagged[rows[i:j]].tobytes() for i, j in zip(begin, ends)),
                               *[names[sure].astype("<u8").tobytes()] * len(sure[:1])], pa.binary()),
            "counts": pa.array([*[None] * len(begin), *[(-n[sure]).astype("<i4").tobytes()] * len(sure[:1])], pa.binary())})


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(range, n-grams, names, flags), ordered by n-gram and name, of every range of ``_packed``; its
    rows come range by range.  Rows of counts give (None, None, names, counts)."""
    now, grams, names = None, [], []

    def rows() -> tuple:
        g, raw = np.frombuffer(b"".join(grams), "<u4"), np.zeros((sum(map(len, names)) // 6, 8), np.uint8)
        raw[:, :6] = np.frombuffer(b"".join(names), np.uint8).reshape(-1, 6)
        x = raw.view("<u8").ravel()
        order = np.lexsort((x, g))
        return now, g[order], (x[order] >> np.uint64(1)).astype(np.int64), (x[order] & np.uint64(1)) == 1

    for b in batches:
        for at, g, x, c in zip(*(b.column(k).to_pylist() for k in range(4))):
            if g is None:
                yield None, None, np.frombuffer(x, "<u8").astype(np.int64), np.frombuffer(c, "<i4")
                continue
            if at != now and grams:
                yield rows()
                grams, names = [], []
            now = at
            grams.append(g)
            names.append(x)
    if grams:
        yield rows()


def _holders(g: np.ndarray, names: np.ndarray) -> np.ndarray:
    """For each row, the number of different names that its n-gram has."""
    fresh = np.concatenate([[True], g[1:] != g[:-1]])
    begin = np.flatnonzero(fresh)
    other = fresh | np.concatenate([[True], names[1:] != names[:-1]])
    return np.repeat(np.add.reduceat(other.astype(np.int64), begin), np.diff(np.append(begin, len(g))))


def _shared(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Names of records and the number of n-grams they share with another record, as far as this task sees them.

    They go packed, a row for each of 2 ** ``bits`` ranges of names: a record's n-grams lie in as many tasks as
    there are, so rows of single records would grow with the records times the tasks.
    """
    def rows() -> pa.RecordBatch:
        name, n = _sums(found, counts)
        found.clear()
        counts.clear()
        at = (name >> (47 - bits)).astype(np.int32)
        begin = np.flatnonzero(np.diff(at, prepend=-1))
        ends = np.append(begin[1:], len(name))
        short = name.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :6]
        return pa.RecordBatch.from_pydict({
            "at": pa.array(at[begin], pa.int32()),
            "names": pa.array([short[i:j].tobytes() for i, j in zip(begin, ends)], pa.binary()),
            "counts": pa.array([n[i:j].astype("<i4").tobytes() for i, j in zip(begin, ends)], pa.binary())})

    found, counts, size = [], [], 0
    for at, g, names, flags in _ranges(batches):
        if at is None:
            found.append(names)
            counts.append(flags)
        else:
            found.append(names[(_holders(g, names) > 1) & flags])
            counts.append(np.ones(len(found[-1]), np.int32))
        size += len(found[-1])
        if size > HELD:
            yield rows()
            size = 0
    if size:
        yield rows()


def _sums(names: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each different name, ascending, and the sum of its counts."""
    name, of = np.unique(np.concatenate(names), return_inverse=True)
    return name, np.bincount(of, np.concatenate(counts)).astype(np.int64)


def _summed(t: pa.Table) -> pa.Table:
    """(node, n-grams shared with another record) of ``_shared``'s rows of one range of names."""
    raw = np.frombuffer(b"".join(t["names"].to_pylist()), np.uint8).reshape(-1, 6)
    names = np.pad(raw, ((0, 0), (0, 2))).view("<i8").ravel()
    node, shared = _sums([names], [np.frombuffer(b"".join(t["counts"].to_pylist()), "<i4")])
    return pa.table({"node": pa.array(node), "shared": pa.array(shared)})


def _frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, n-gram, number of records that have it) for n-grams of several records."""
    for at, g, names, _ in _ranges(batches):
        many = _holders(g, names)
        keep = many > 1
        yield pa.RecordBatch.from_pydict({"node": pa.array(names[keep]), "many": pa.array(many[keep].astype(np.int32)),
                                          "gram": pa.array(g[keep].astype(np.int64) | np.int64(at) << np.int64(32))})


def _sets(batches: Iterator[pa.RecordBatch], n: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Sets of the texts that have the digest looked for (an id may stand on several texts), and how many
    n-grams of their longer prefixes they share at least."""
    for b in batches:
        digests, sets, need = [], [], []
        for text, digest in zip(_values(b.column("text")), _values(b.column("digest"))):
            x = shingles(text, n)
            if _digest(x) == digest:
                digests.append(digest)
                sets.append(x.astype("<u8").tobytes())
                need.append(longer_prefix(x, num, den)[1])
        yield pa.RecordBatch.from_pydict({
            "digest": pa.array(digests, pa.binary()), "node": pa.array([_node(d) for d in digests], pa.int64()),
            "grams": pa.array(sets, pa.binary()), "need": pa.array(need, pa.int32())})


def _prefixes(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """(n-gram, record, 1) for the n-grams of longer prefixes."""
    grams, nodes, size = [], [], 0

    def rows() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict({"gram": pa.array(np.concatenate(grams).view(np.int64)),
                                          "node": pa.array(np.concatenate(nodes)), "n": pa.array(np.ones(size, np.int32))})
        grams.clear()
        nodes.clear()
        return out

    for b in batches:
        for node, x in zip(_values(b.column(0)), _values(b.column(1))):
            head, _ = longer_prefix(np.frombuffer(x, "<u8"), num, den)
            grams.append(head.copy())
            nodes.append(np.full(len(head), node))
            size += len(head)
            if size > HELD:
                yield rows()
                size = 0
    if grams:
        yield rows()


def _chained(batches: Iterator[pa.RecordBatch], most: int = HELD) -> Iterator[pa.RecordBatch]:
    """Rows (n-gram, record, other record): records of equal n-grams tied together where they meet first.

    Among the records read together an n-gram's records form a chain, whose different links go on
    (under a key of their own); the n-gram itself goes on with its smallest record and no other.
    """
    def rows(keys: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((nodes, keys))
        k, x = keys[order], nodes[order]
        fresh = np.concatenate([[True], k[1:] != k[:-1]])
        later = np.flatnonzero(~fresh)
        pairs = np.unique(np.stack([x[later], x[later - 1]], axis=1), axis=0)
        a, b = pairs[pairs[:, 0] != pairs[:, 1]].T
        none = int(fresh.sum())
        return pa.RecordBatch.from_pydict({
            "key": pa.array(np.concatenate([k[fresh], a])), "a": pa.array(np.concatenate([x[fresh], a])),
            "b": pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(b, pa.int64())])})

    held, size = [], 0
    for batch in batches:
        lists = batch.column(1)
        lens = np.diff(lists.offsets.to_numpy())
        held.append((lists.flatten().to_numpy(), np.repeat(batch.column(0).to_numpy(), lens)))
        size += int(lens.sum())
        if size > most:
            yield rows(*map(np.concatenate, zip(*held)))
            held, size = [], 0
    if size:
        yield rows(*map(np.concatenate, zip(*held)))


class Trie:
    """Sets of ranks (ascending), ready for traversal by many records at once."""

    def __init__(self, seqs: list[np.ndarray], sizes: np.ndarray):
        raw = [s.astype(">u4").tobytes() for s in seqs]
        self.rows = sorted(range(len(seqs)), key=raw.__getitem__)
        self.raw = [raw[r] for r in self.rows]
        self.seqs = [seqs[r] for r in self.rows]
        self.sizes = sizes[self.rows]

    def overlaps(self, has: np.ndarray, lens: np.ndarray, sizes: np.ndarray, num: int, den: int):
        """Yields (row of the trie's input, linked records), walking down shared paths once.

        ``has[rank, record]`` marks the ranks of the records, ``lens`` their number of ranks
        and ``sizes`` their whole set sizes.
        """
        stack = [(0, len(self.seqs), 0, np.arange(has.shape[1]), np.zeros(has.shape[1], np.int64))]
        while stack:
            lo, hi, depth, live, over = stack.pop()
            a, z = self.seqs[lo], self.seqs[hi - 1]
            end = min(len(a), len(z))
            if hi - lo > 1:  # neighbours in order differ first where the outermost two do
                differ = np.flatnonzero(a[depth:end] != z[depth:end])
                end = depth + int(differ[0]) if len(differ) else end
            else:
                end = len(a)
            left = max(len(s) for s in self.seqs[lo:hi]) - depth
            can = over + np.minimum(left, lens[live] - over)
            live_now = can * (num + den) >= num * (sizes[live] + self.sizes[lo:hi].min())
            if not live_now.any():
                continue
            if not live_now.all():
                live, over = live[live_now], over[live_now]
            step = max(1, MARKS // 8 // has.shape[1])  # bounds the copies of marks
            for k in range(depth, end, step):
                over = over + has[a[k:min(end, k + step)]][:, live].sum(axis=0, dtype=np.int64)
            at = lo
            while at < hi and len(self.seqs[at]) == end:
                hit = over * (num + den) >= num * (sizes[live] + self.sizes[at])
                yield self.rows[at], live[hit]
                at += 1
            while at < hi:  # one child for each next rank
                token, stop = self.seqs[at][end], at + 1
                while stop < hi and self.seqs[stop][end] == token:
                    stop += 1
                stack.append((at, stop, end, live, over))
                at = stop


def link_block(grams: list[np.ndarray], mine: np.ndarray, other: np.ndarray, num: int, den: int) -> np.ndarray:
    """Labels (a row's smallest connected row) by the links between rows ``mine`` and rows ``other``."""
    label = np.arange(len(grams))
    if not len(mine) or not len(other):  # a block without records
        return label
    sizes = np.array([len(g) for g in grams], dtype=np.int64)
    every, inverse, counts = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(counts > 1)  # others add nothing to an overlap
    by_order = shared[np.lexsort((every[shared], -counts[shared]))]
    rank = np.full(len(every), -1, np.int64)
    rank[by_order] = np.arange(len(by_order))
    ends = np.cumsum(sizes)
    seqs = []
    for a, b in zip(ends - sizes, ends):
        r = rank[inverse[a:b]]
        seqs.append(np.sort(r[r >= 0]))
    trie = Trie([seqs[r] for r in mine], sizes[mine])
    step = max(1, MARKS // max(1, len(by_order)))  # bounds the matrix of marks
    for k in range(0, len(other), step):
        probe = other[k:k + step]
        has = np.zeros((len(by_order), len(probe)), np.uint8)
        for c, r in enumerate(probe):
            has[seqs[r], c] = 1
        lens = np.array([len(seqs[r]) for r in probe], dtype=np.int64)
        for row, hit in trie.overlaps(has, lens, sizes[probe], num, den):
            labels = np.unique(label[np.append(probe[hit], mine[row])])
            if len(labels) > 1:
                label[np.isin(label, labels)] = labels[0]
    return label


def _meeting(grams: list[np.ndarray], mine: np.ndarray, other: np.ndarray, num: int, den: int) -> tuple:
    """The rows of either block that have a part in common with one of the other block."""
    def keys(rows: np.ndarray) -> tuple:
        found = [part_keys(grams[r], num, den) for r in rows]
        return np.repeat(rows, [len(k) for k in found]), np.concatenate([np.zeros(0, np.uint64), *found])

    (a, x), (b, y) = keys(mine), keys(other)
    return np.unique(a[np.isin(x, y)]), np.unique(b[np.isin(y, x)])


def _link(t: pa.Table, num: int, den: int) -> pa.Table:
    digests = t["digest"].to_pylist()
    grams = [np.frombuffer(g, "<u8") for g in t["grams"].to_pylist()]
    block, i, j = t["block"].to_numpy(), t["i"][0].as_py(), t["j"][0].as_py()
    mine, other = np.flatnonzero(block == i), np.flatnonzero(block == j)
    if i != j:
        mine, other = _meeting(grams, mine, other, num, den)
    label = link_block(grams, mine, other, num, den)
    rows = np.flatnonzero(label != np.arange(len(label)))
    return pa.table({"a": pa.array([digests[r] for r in rows], pa.binary()),
                     "b": pa.array([digests[label[r]] for r in rows], pa.binary())})


def range_bits(df: DataFrame) -> int:
    """2 to this power ranges make four or more a shuffle partition."""
    return min(16, 2 + int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")).bit_length())


def by_range(df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Rows (gram, node, n) that ``rows`` makes of ``df``, packed and dealt by ranges of n-grams, four a partition.

    A task holds one range at a time, and rows are made and packed by the same Python worker.
    """
    bits = range_bits(df)
    return (df.mapInArrow(lambda it: _packed(rows(it), bits), "at int, grams binary, names binary, counts binary")
            .repartition("at").sortWithinPartitions("at"))


def candidates(texts: DataFrame, records: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Names of the records that may link (step 1)."""
    bits = range_bits(texts)
    shared = (by_range(texts.select("text"), lambda it: _first(it, n, num, den))
              .mapInArrow(lambda it: _shared(it, bits), "at int, names binary, counts binary")
              .groupBy("at").applyInArrow(_summed, "node long, shared long"))
    need = needed(F.col("n_shingles"), num, den, lambda a, b: F.call_function("div", a, F.lit(b)), F.least)
    return (records.join(shared, "node").filter(F.col("shared") >= need)
            .groupBy("digest").agg(F.min("_id").alias("_rep")))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80,
            den: int = 100, block_rows: int = 1000, block_bytes: int = 4_000_000) -> DataFrame:
    """(id, n_shingles, component_id): classes of documents linked by Jaccard >= num / den.

    component_id is the smallest id that links reach from a document, its own included.
    """
    small_batches(docs)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    records = materialise(texts.mapInArrow(
        lambda it: _records(it, n), with_fields(texts, "n_shingles long, digest binary, node long")))
    wanted = materialise(candidates(texts, records, n, num, den))
    near = marked(texts, "_id", wanted.select(F.col("_rep").alias("_id")), "_near").filter("_near")
    found = materialise(near.join(wanted, F.col("_id").eqNullSafe(F.col("_rep"))).select("text", "digest")
                        .mapInArrow(lambda it: _sets(it, n, num, den), "digest binary, node long, grams binary, need int"))
    common = Window.partitionBy("node").orderBy(F.desc("many"), F.desc("gram"))
    rare = (by_range(found.select("node", "grams"), lambda it: _prefixes(it, num, den)).mapInArrow(_frequency, "node long, many int, gram long")
            .join(found.groupBy("node").agg(F.min("need").alias("need")), "node")
            .withColumn("place", F.row_number().over(common)).filter(F.col("place") >= F.col("need")))
    line = Window.partitionBy("key").orderBy("a")  # a hot n-gram has one row for each HELD read
    chains = (rare.groupBy("node").agg(F.collect_list("gram")).mapInArrow(_chained, "key long, a long, b long")
              .withColumn("b", F.coalesce("b", F.lag("a").over(line))).filter("b != a").select("a", "b"))
    grouped = (found.select("digest", "node", F.length("grams").alias("size")).join(components(chains), "node")
               .select("digest", F.col("root").alias("grp"), "size"))
    blocks = grouped.groupBy("grp").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / block_rows, F.sum("size") / block_bytes)).cast("int").alias("n_blocks"))
    placed = grouped.join(blocks, "grp").select("digest", "grp", "n_blocks").distinct()
    dealt = (found.select("digest", "grams").join(placed, "digest")
             .withColumn("block", F.pmod(F.xxhash64("digest", F.lit(1)), F.col("n_blocks")).cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
             .withColumn("i", F.least("block", "_other")).withColumn("j", F.greatest("block", "_other"))
             .select(F.struct("grp", "i", "j").alias("pair"), "i", "j", "block", "digest", "grams"))
    links = dealt.groupBy("pair").applyInArrow(lambda t: _link(t, num, den), "a binary, b binary")
    roots = components(links).select(F.col("node").alias("digest"), "root")
    sets = records.filter("n_shingles > 0").groupBy("digest").agg(F.min("_id").alias("_id"))
    members = sets.join(roots, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    least = members.groupBy("root").agg(F.min("_id").alias("component_id"))
    of = members.join(least, "root").select(F.col("digest").alias("_digest"), "component_id")
    return (records.join(of, (F.col("n_shingles") > 0) & (F.col("digest") == F.col("_digest")), "left")
            .select(F.col("_id").alias(id_col), "n_shingles", F.coalesce("component_id", "_id").alias("component_id")))
