"""Set similarity self-join of documents on a prefix tree.

A document is the set of its five-word shingles. One order of all shingles, rare
ones first, holds everywhere. Documents of Jaccard similarity 0.8 share one of
their first shingles in that order (prefix filter), so those that do are brought
together in cells of bounded size. A cell stores its sets in a prefix tree, the
frequent end of the order at the root, where near copies share their paths. A set
traverses the tree: what it shares with a path is counted once for all sets below,
and a subtree is left as soon as the shingles that remain in its sets, or in the
set itself, cannot reach the overlap any more, or all its sets are already known
to be linked with it.

The join is exact. What it returns are the classes of linked documents; a link
inside a class that is already connected is not looked for.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelweave.llm.common import table, whole_text
from labelweave.llm.filters import filter_of, found, may_hold
from labelweave.llm.order_minhash import components
from labelweave.session import materialise

SHINGLE_WORDS = 5
PAIRED_SETS = 256  # sets of a shingle that are paired at once; of more the classes are found first
BATCH_SHINGLES = 1 << 20  # of the cells that are handed to Python together, about
CELL_SHINGLES = 1 << 18  # of a probe's cell, about
CELL_SETS = 4096  # sets of a hot shingle that are compared with as many others in a task, about
RARE = 4  # counted sets from which a shingle is frequent; levels are its powers
LEVELS = 7
_HASH_BITS = 60  # of a shingle; the three bits above are its level, the sign stays free
_MARK_BITS = 2048
_FINE_BITS = 1 << 16  # of the mark of a very large set; only more sets are compared for it
_CHUNK = 1 << 20  # bytes hashed at once, about
_ODD = 0x9E3779B97F4A7C15
_MASK = 0xFFFFFFFFFFFFFFFF
_SIZE_STEP = 1.25  # linked sets are of the same class of sizes, or of neighbouring ones


# Sets

def _mixed(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base, count):
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _word_hashes(data):
    """64-bit hashes of the words of bytes in lower case, and where they begin.
    All words at once: a word is the difference of two sums of bytes by powers of
    an odd number, divided by the power at which it begins."""
    codes = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], ~((codes == 32) | ((codes >= 9) & (codes <= 13))), [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edges[::2], edges[1::2]
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _powers(_ODD, len(codes)), out=sums[1:])
    back = _powers(pow(_ODD, -1, 1 << 64), len(codes))
    words = (sums[end] - sums[begin]) * back[begin]
    return _mixed(words + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), begin


def _runs(words):
    """Hashes of every run of five words."""
    count = max(0, len(words) - SHINGLE_WORDS + 1)
    out = np.zeros(count, np.uint64)
    for j in range(SHINGLE_WORDS):
        out += words[j:j + count] * np.uint64(pow(_ODD, j + 1, 1 << 64))
    return _mixed(out)


def _chunks(texts):
    """Lists of texts, as bytes, of about _CHUNK bytes; a longer text is alone."""
    chunk, size = [], 0
    for text in texts:
        data = text.encode().lower()
        if chunk and size + len(data) > _CHUNK:
            yield chunk
            chunk, size = [], 0
        chunk.append(data)
        size += len(data)
    if chunk:
        yield chunk


def _long_words(data):
    """Word hashes of a very long text, piece by piece, cut at blanks."""
    out, at = [], 0
    while at < len(data):
        to = at + _CHUNK
        while to < len(data) and data[to] not in b" \t\n\x0b\x0c\r":
            to += 1
        out.append(_word_hashes(data[at:to])[0])
        at = to
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingle_sets(texts):
    """For every text its distinct hashed shingles, sorted: runs of five words in
    lower case (A-Z only), or the whole of a shorter text; none without words."""
    for chunk in _chunks(texts):
        if len(chunk) == 1:
            words, cuts = _long_words(chunk[0]), []
        else:
            words, begin = _word_hashes(b" ".join(chunk))
            cuts = np.searchsorted(begin, np.cumsum([len(d) + 1 for d in chunk])[:-1])
        for own in np.split(words, cuts):
            if 0 < len(own) < SHINGLE_WORDS:
                own = np.concatenate([own, np.zeros(SHINGLE_WORDS - len(own), np.uint64)])
            yield np.unique(_runs(own) >> np.uint64(64 - _HASH_BITS))


def overlap_needed(a, b):
    """Least overlap of linked sets: 100 * overlap >= 80 * union."""
    return -(-4 * (a + b) // 9)


def probe_length(n):
    """Of linked sets the longer has one of its first so many shingles among the
    first ``index_length`` of the shorter."""
    return n - -(-4 * n // 5) + 1 if n else 0


def probe_length_of(sizes):
    return sizes - -(-4 * sizes // 5) + 1


def index_length(n):
    return n - -(-8 * n // 9) + 1 if n else 0


def _index_length(n):
    return F.col(n) - F.ceil(8 * F.col(n) / 9) + 1


def _probe_length(n):
    return F.col(n) - F.ceil(4 * F.col(n) / 5) + 1


# The order of all shingles: by level (how frequent a filter says they are), then
# by hash; a shingle with its level above its hash is its place in the order.

def _level_keys(tokens, level):
    return _mixed(tokens + np.uint64(_ODD * level & _MASK))


def ordered(tokens, bits):
    """Sorted hashes as places in the order, sorted."""
    level = np.zeros(len(tokens), np.uint64)
    at = np.arange(len(tokens))
    for n in range(1, LEVELS + 1 if bits is not None else 1):
        at = at[found(bits, _level_keys(tokens[at], n))]
        if not len(at):
            return tokens if n == 1 else np.sort(level << np.uint64(_HASH_BITS) | tokens)
        level[at] = n
    return np.sort(level << np.uint64(_HASH_BITS) | tokens)


def _digest(tokens):
    return hashlib.md5(tokens.tobytes()).digest()


def frequent_filter(docs):
    """The filter of frequent shingles, each with its levels. A shingle counts in
    every text that has it among the first ninth of its set by hash; equal texts
    of a task count once."""
    def counted(batches):
        seen = set()
        for batch in batches:
            some = [np.empty(0, np.uint64)]
            for tokens in shingle_sets(batch["text"]):
                digest = _digest(tokens)
                if digest not in seen:
                    seen.add(digest)
                    some.append(tokens[:index_length(len(tokens))])
            tokens, counts = np.unique(np.concatenate(some), return_counts=True)
            yield pd.DataFrame({"token": tokens.view(np.int64), "n": counts})

    def keys_of(batch):
        tokens, counts = batch["token"].to_numpy().view(np.uint64), batch["n"].to_numpy()
        return np.concatenate([np.empty(0, np.uint64)] + [
            _level_keys(tokens[counts >= RARE ** n], n) for n in range(1, LEVELS + 1)])

    counts = materialise(docs.select("text").mapInPandas(counted, "token long, n long").groupBy("token")
                         .agg(F.sum("n").alias("n")).where(F.col("n") >= RARE), "frequent")
    return filter_of(keys_of, counts, 2 * counts.count())


def _mark(tokens, bits=_MARK_BITS):
    """A set in 2048 bits, or another power of two, each the parity of the shingles
    it stands for: two sets differ in at least as many shingles as their marks in
    bits."""
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _fine_mark(tokens):
    """The mark of a set of more shingles than 2048 in at least as many bits, for in
    fewer all large sets look alike; None of other sets."""
    bits = min(1 << (len(tokens) - 1).bit_length(), _FINE_BITS)
    return _mark(tokens, bits) if bits > _MARK_BITS else None


def marks_differ(a, b):
    """In how many bits two marks differ; a longer one is folded to the bits of the other."""
    words = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(np.asarray(m, np.int64).reshape(-1, words), axis=0) for m in (a, b))
    return int(np.bitwise_count((a ^ b).view(np.uint64)).sum(dtype=np.int64))


def _listed(docs, bits):
    """row (a number), doc_id, digest of the set (null if empty), size, and, but
    where the task listed an equal set before, its first places and its marks."""
    def run(batches):
        seen = set()
        for batch in batches:
            rows = []
            for tokens in shingle_sets(batch["text"]):
                digest = _digest(tokens) if len(tokens) else None
                first = mark = fine = None
                if digest not in seen and len(tokens):
                    seen.add(digest)
                    first, mark = ordered(tokens, bits)[:probe_length(len(tokens))].view(np.int64), _mark(tokens)
                    fine = _fine_mark(tokens)
                rows.append((digest, len(tokens), first, mark, fine))
            out = pd.DataFrame(rows, columns=["digest", "n", "first", "mark", "fine"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64"))
            yield out

    return docs.mapInPandas(
        run, "doc_id long, digest binary, n long, first array<long>, mark array<long>, fine array<long>").withColumn(
            "row", F.monotonically_increasing_id())


def _postings(listed, sets):
    """token, vid, n, pos, indexed, last (the last of the set's first places), share
    (how many of them others share, about) and size, the number of sets that have the
    token among their first places, of those that two sets share.

    Of equal sets that several tasks list one is kept; a filter tells which sets may
    have to go, so that few are moved for that. Another leaves most places that no two
    sets share where they lie.
    """
    rows = listed.where("first is not null").select(F.col("row").alias("vid"), "n", "first")
    vids = sets.select("vid")
    spare = materialise(rows.select("vid").join(vids, "vid", "left_anti"), "spare")
    row_keys = lambda batch: batch["vid"].to_numpy(dtype=np.int64).view(np.uint64)
    doubted = filter_of(row_keys, spare, spare.count())

    @F.pandas_udf(T.BooleanType())
    def doubt(vids: pd.Series) -> pd.Series:
        return pd.Series(found(doubted, vids.to_numpy(dtype=np.int64).view(np.uint64)))

    maybe = doubt("vid")
    once = materialise(rows.where(maybe).join(vids, "vid").select(*rows.columns), "once")
    shared = materialise(rows.where(~maybe).union(once).select(F.explode("first").alias("token")).groupBy("token")
                         .agg(F.count("*").alias("size")).where("size > 1"), "shared")
    keys = lambda batch: _mixed(batch["token"].to_numpy().view(np.uint64))
    bits = filter_of(keys, shared.select("token"), shared.count())

    def places(batches):
        for batch in batches:
            sizes = batch["first"].map(len).to_numpy(dtype=np.int64)
            at = np.repeat(np.arange(len(batch)), sizes)
            tokens = np.concatenate([np.empty(0, np.int64), *batch["first"]]).astype(np.int64)
            pos = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            last = np.array([first[-1] for first in batch["first"]], np.int64)
            keep = found(bits, _mixed(tokens.view(np.uint64)))
            at = at[keep]
            share = np.bincount(at, minlength=len(batch))
            yield pd.DataFrame({"token": tokens[keep], "vid": batch["vid"].to_numpy()[at],
                                "n": batch["n"].to_numpy()[at], "pos": pos[keep], "last": last[at], "share": share[at]})

    def sure(batches):
        return places(batch[~found(doubted, row_keys(batch))] for batch in batches)

    schema = "token long, vid long, n long, pos long, last long, share long"
    held = materialise(rows.mapInPandas(sure, schema).union(once.mapInPandas(places, schema)), "held")
    return held.withColumn("indexed", F.col("pos") < _index_length("n")).join(shared, "token")


def _owner_keys(ids, digests):
    """A key of the row that a set is read from: its document and digest."""
    ids = ids.fillna(-1).to_numpy(dtype=np.int64).view(np.uint64)
    return _mixed(np.array([int.from_bytes(d[:8], "little") for d in digests], np.uint64) + ids * np.uint64(_ODD))


def _sets_of(docs, wanted, bits):
    """digest and places (sorted, as bytes) of the wanted vid, doc_id, digest and
    of few others. Filters pick them out of the scan, so that no text is moved, and
    by the documents before shingles are made; the joins on the digest are exact. A
    set may come once from every task."""
    keys = lambda b: _mixed(b["doc_id"].astype("Int64").fillna(-1).to_numpy(dtype=np.int64).view(np.uint64))
    some = filter_of(keys, wanted.select("doc_id"), wanted.count())
    owners = filter_of(lambda b: _owner_keys(b["doc_id"].astype("Int64"), b["digest"]),
                       wanted.select("doc_id", "digest"), wanted.count())

    def run(batches):
        seen = set()
        for batch in batches:
            batch = batch[found(some, keys(batch))]
            rows = [(_digest(t), t) for t in shingle_sets(batch["text"])]
            keep = found(owners, _owner_keys(batch["doc_id"].astype("Int64"), [d for d, _ in rows]))
            out = []
            for digest, tokens in (rows[i] for i in np.flatnonzero(keep)):
                if digest not in seen:
                    seen.add(digest)
                    out.append((digest, ordered(tokens, bits).tobytes()))
            yield pd.DataFrame(out, columns=["digest", "data"])

    return docs.mapInPandas(run, "digest binary, data binary")


# The tree of a cell

class Tree:
    """A path-compressed prefix tree of sequences, as flat arrays in preorder.

    Node i holds the items ``begin[i]:end[i]`` of sequence ``of[i]``, its subtree
    the sequences ``low[i]:high[i]`` in sorted order and the nodes i to skip[i].
    """

    def __init__(self, sequences):
        """``sequences`` are arrays of small integers."""
        keys = [s.astype(">u4").tobytes() for s in sequences]
        self.order = sorted(range(len(sequences)), key=keys.__getitem__)
        self.sequences = [sequences[i] for i in self.order]
        sizes = [len(s) for s in self.sequences]
        shared = [0] * (len(sizes) + 1)
        for i in range(1, len(sizes)):
            a, b = self.sequences[i - 1], self.sequences[i]
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            shared[i] = int(differ[0]) if len(differ) else n
        self.begin, self.end, self.of, self.low, self.high, self.up, self.skip = ([] for _ in range(7))
        self._grow(sizes, shared)
        self.least = [min(sizes[a:b]) for a, b in zip(self.low, self.high)]
        self.most = [max(sizes[a:b]) for a, b in zip(self.low, self.high)]

    def _grow(self, sizes, shared):
        # (low, high, depth, parent): sequences that agree up to depth.
        work = [(0, len(sizes), 0, -1)] if sizes else []
        closing = []
        while work:
            low, high, depth, up = work.pop()
            while closing and closing[-1][1] <= low:
                self.skip[closing.pop()[0]] = len(self.begin)
            inner = shared[low + 1:high]
            to = min(inner) if inner else sizes[low]
            node = len(self.begin)
            for column, value in zip((self.begin, self.end, self.of, self.low, self.high, self.up, self.skip),
                                     (depth, to, low, low, high, up, 0)):
                column.append(value)
            closing.append((node, high))
            if not inner:
                continue
            cuts = [low] + [low + 1 + i for i, n in enumerate(inner) if n == to] + [high]
            work.extend((a, b, to, node) for a, b in reversed(list(zip(cuts, cuts[1:]))))
        for node, _ in closing:
            self.skip[node] = len(self.begin)

    def similar(self, present, size, linked):
        """Positions (of the sequences as given) of those that a set of ``size``
        items is linked with. ``present`` tells of every item whether the set has
        it; a subtree low:high is passed over where ``linked(low, high)``."""
        overlap, i = [0] * len(self.begin), 0
        while i < len(self.begin):
            depth = self.end[i]
            run = self.sequences[self.of[i]][self.begin[i]:depth]
            common = (overlap[self.up[i]] if self.up[i] >= 0 else 0) + int(np.count_nonzero(present[run]))
            overlap[i] = common
            most, low, high = self.most[i], self.low[i], self.high[i]
            if (9 * (common + most - depth) < 4 * (most + size) or 5 * size < 4 * self.least[i]
                    or linked(low, high)):
                i = self.skip[i]
                continue
            if high - low == 1 and common >= overlap_needed(size, depth):
                yield self.order[low]
            i += 1


def cell_links(vids, labels, sets, probes, built):
    """Links (vid, vid) that connect every two classes of the cell between which
    a probe and a set of the tree are similar. ``labels`` are the classes known."""
    if not built or not probes:
        return []
    items, codes = np.unique(np.concatenate(sets), return_inverse=True)
    codes = np.split(codes.astype(np.uint32), np.cumsum([len(s) for s in sets])[:-1])
    tree = Tree([codes[i][::-1] for i in built])
    of = [labels[built[i]] for i in tree.order]
    ends = np.cumsum([0] + [a != b for a, b in zip(of, of[1:])]).tolist()  # equal where a run of one class goes on
    root = {label: label for label in labels}

    def find(label):
        while root[label] != label:
            root[label] = label = root[root[label]]
        return label

    links, present = [], np.zeros(len(items), bool)
    for p in probes:
        mine = labels[p]
        present[codes[p]] = True
        linked = lambda low, high: ends[low] == ends[high - 1] and find(of[low]) == find(mine)
        for i in tree.similar(present, len(codes[p]), linked):
            a, b = find(mine), find(labels[built[i]])
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((vids[p], vids[built[i]]))
        present[codes[p]] = False
    return links


# On Spark

def _joined(cells, sets, wanted, labels):
    """Links found in the cells: (cell, vid, probe, built), each with its set and
    class."""
    def run(batch):
        links = []
        for _, cell in batch.groupby("cell", sort=False):
            rows = cell.groupby("vid", sort=True).agg(
                {"probe": "max", "built": "max", "label": "first", "data": "first"}).reset_index()
            data = [np.frombuffer(d, np.uint64) for d in rows["data"]]
            at = lambda flag: np.flatnonzero(rows[flag].to_numpy()).tolist()
            links += cell_links(rows["vid"].tolist(), rows["label"].tolist(), data, at("probe"), at("built"))
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    known = cells.join(wanted.select("vid", "digest", "n"), "vid")
    known = (known.withColumn("label", F.col("vid")) if labels is None else
             known.join(labels.withColumnRenamed("vertex", "vid"), "vid", "left")
             .withColumn("label", F.coalesce("label", "vid")))
    known = materialise(known, "cells")
    batches = known.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"] // BATCH_SHINGLES + 1
    return (known.join(sets, "digest").drop("digest", "n").groupBy(F.pmod("cell", F.lit(batches)).alias("batch"))
            .applyInPandas(run, "a long, b long"))


def _possible(x, y):
    """Whether a set and another can be linked if the shingle they meet at is the
    first they share: sizes, what remains of both, and the shorter's index."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    rest = F.least(n - F.col(f"{x}.pos"), m - F.col(f"{y}.pos"))
    first = (n < m) | ((n == m) & (F.col(f"{x}.vid") < F.col(f"{y}.vid")))
    return ((5 * n >= 4 * m) & (5 * m >= 4 * n) & (9 * rest >= 4 * (n + m))
            & F.when(first, F.col(f"{x}.indexed")).otherwise(F.col(f"{y}.indexed")))


def _star_pairs(members, marks):
    """Written pairs (a, an, b, bn) of sets, with their sizes: every set with the hub of
    each of its shingles, the set that shares most of its first places with others, if
    it may be linked with it. They are no more than the places of the sets."""
    # Written, so that adaptive execution can split the sets of a hot shingle.
    hubs = materialise(members.groupBy("token").agg(F.max(F.struct("share", "vid", "n", "pos", "indexed")).alias("y")), "hubs")
    stars = (members.select("token", F.struct("vid", "n", "pos", "indexed").alias("x")).join(hubs, "token")
             .where("x.vid <> y.vid").where(_possible("x", "y"))
             .select(F.least(F.struct("x.vid", "x.n"), F.struct("y.vid", "y.n")).alias("x"),
                     F.greatest(F.struct("x.vid", "x.n"), F.struct("y.vid", "y.n")).alias("y")))
    return _marked(stars.select(F.col("x.vid").alias("a"), F.col("x.n").alias("an"), F.col("y.vid").alias("b"),
                                F.col("y.n").alias("bn")).distinct(), marks)


def _between(members, labels):
    """The places of sets at shingles that sets of several classes have, written, with
    the class, and with ``more``, how many of them are shingles of more than
    PAIRED_SETS sets."""
    known = materialise(members.join(labels.withColumnRenamed("vertex", "vid"), "vid", "left")
                        .withColumn("label", F.coalesce("label", "vid")), "known")
    mixed = known.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    known = materialise(known.join(materialise(mixed.select("token"), "mixed"), "token"), "mixed")
    more = known.where(F.col("size") > PAIRED_SETS).groupBy("vid").agg(F.count("*").alias("more"))
    return known.join(materialise(more, "more"), "vid", "left").fillna(0, ["more"])


def _candidates(known, marks):
    """Written pairs (a, an, b, bn) of sets of different classes that may be linked.

    Sets that meet at a shingle of at most PAIRED_SETS are paired, and what all
    their first places have in common bounds their overlap: of the one whose first
    places end first, none of them is in the other but those. A shingle of more
    sets could be in common beside those.
    """
    few = known.where(F.col("size") <= PAIRED_SETS)
    side = lambda s: few.select("token", F.struct(
        "vid", "n", "pos", "indexed", "last", "more", "label").alias(s))
    ends = [F.col(f"{s}.{c}").alias(f"{s}{c}") for s in "xy" for c in ("vid", "n", "last", "more")]
    met = (side("x").join(side("y"), "token").where("x.vid < y.vid and x.label <> y.label")
           .where("5 * x.n >= 4 * y.n and 5 * y.n >= 4 * x.n").groupBy(*ends)
           .agg(F.count("*").alias("common"), F.max(_possible("x", "y")).alias("possible")))
    rest = F.when(F.col("xlast") <= F.col("ylast"), F.col("xn") - _probe_length("xn")).otherwise(
        F.col("yn") - _probe_length("yn"))
    # The first shingle in common may be one of those of more sets.
    more = F.least("xmore", "ymore")
    pairs = met.where(F.col("possible") | (more > 0)).where(
        9 * (F.col("common") + more + rest) >= 4 * (F.col("xn") + F.col("yn")))
    return _marked(pairs.select(F.col("xvid").alias("a"), F.col("xn").alias("an"), F.col("yvid").alias("b"),
                                F.col("yn").alias("bn")), marks)


def _marked(pairs, marks):
    """The pairs whose marks allow a link, written. A filter leaves most marks of
    other sets where they lie."""
    pairs = materialise(pairs, "pairs")
    ends = materialise(pairs.select(F.col("a").alias("vid")).union(pairs.select("b")).distinct(), "ends")
    own = materialise(marks.where(may_hold(ends, "vid")(F.col("vid"))).select("vid", F.coalesce("fine", "mark").alias("mark")), "marks")
    mark = lambda s: own.select(F.col("vid").alias(s), F.col("mark").alias(f"{s}_mark"))

    @F.pandas_udf(T.LongType())
    def differ(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([marks_differ(x, y) for x, y in zip(a, b)], dtype="int64")

    both = F.col("an") + F.col("bn")
    return materialise(pairs.join(mark("a"), "a").join(mark("b"), "b")
                       .where(differ("a_mark", "b_mark") <= both - 2 * F.ceil(4 * both / 9))
                       .select("a", "an", "b", "bn"), "pairs")


def possible_pairs(cell, left, right):
    """Columns (a, an, b, bn) of the pairs of rows of different classes, one at
    ``left``, one at ``right``, that may be linked, if the shingle of the cell is the
    first that they share and nothing but ``more`` shingles of their first places is
    shared. The sizes, the marks and what remains of both bound the overlap."""
    right = right[np.argsort(cell["n"].to_numpy()[right], kind="stable")]
    vid, n, pos, indexed, last, more, label = (
        cell[c].to_numpy() for c in ("vid", "n", "pos", "indexed", "last", "more", "label"))
    marks = np.array([np.asarray(m, np.int64) for m in cell["mark"]]).view(np.uint64)
    low = np.searchsorted(n[right], -(-4 * n[left] // 5), "left")
    high = np.searchsorted(n[right], 5 * n[left] // 4, "right")
    after = n - probe_length_of(n)
    found = [np.empty((4, 0), np.int64)]
    for i, p in enumerate(left.tolist()):
        to = right[low[i]:high[i]]
        both = n[p] + n[to]
        shorter = (n[p] < n[to]) | ((n[p] == n[to]) & (vid[p] < vid[to]))
        to = to[(label[p] != label[to]) & (9 * np.minimum(n[p] - pos[p], n[to] - pos[to]) >= 4 * both)
                & np.where(shorter, indexed[p], indexed[to])
                & (9 * (np.minimum(more[p], more[to]) + np.where(last[p] <= last[to], after[p], after[to])) >= 4 * both)]
        differ = np.bitwise_count(marks[to] ^ marks[p]).sum(axis=1, dtype=np.int64)
        both = n[p] + n[to]
        to = to[differ <= both - 2 * -(-4 * both // 9)]
        first = vid[p] < vid[to]
        found.append(np.where(first, [np.full(len(to), vid[p]), np.full(len(to), n[p]), vid[to], n[to]],
                              [vid[to], n[to], np.full(len(to), vid[p]), np.full(len(to), n[p])]))
    return np.unique(np.concatenate(found, axis=1), axis=1)


def _crowded(known, marks):
    """Written pairs of sets of different classes that have nothing among their
    first places in common but shingles of more than PAIRED_SETS sets, and may be
    linked nevertheless. Sets meet by shingle and class of sizes, in cells of two
    blocks of at most about CELL_SETS; only what the short marks allow leaves a cell,
    and what the fine ones allow is written."""
    steps = (known.where(F.col("size") > PAIRED_SETS).drop("size")
             .withColumn("step", F.floor(F.log(F.col("n")) / F.log(F.lit(_SIZE_STEP)))))
    blocks = (steps.groupBy("token", "step").agg(F.count("*").alias("size"))
              .groupBy("token").agg(F.ceil(F.max("size") / CELL_SETS).alias("blocks")))
    own = materialise(marks.where(may_hold(steps.select("vid"), "vid")(F.col("vid"))).select("vid", "mark"), "marks")
    placed = (steps.join(materialise(blocks, "blocks"), "token").join(own, "vid")
              .withColumn("block", F.pmod(F.xxhash64("vid"), F.col("blocks"))))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    cell = lambda step, first, second, right: F.struct(
        step.alias("of"), first.alias("first"), second.alias("second"), F.lit(right).alias("right"))
    # A set is at the left with the sets of its step and of the next, at the right with those of its step and the last.
    cells = F.explode(F.concat(
        F.transform(every, lambda o: cell(F.col("step"), F.col("block"), o, False)),
        F.transform(F.filter(every, lambda o: o < F.col("block")), lambda o: cell(F.col("step"), o, F.col("block"), True)),
        F.transform(every, lambda o: cell(F.col("step") - 1, o, F.col("block"), True))))

    def run(key, cell):
        right = cell["right"].to_numpy(bool)
        to = np.flatnonzero(right) if key[2] != key[3] else np.arange(len(cell))
        a, an, b, bn = possible_pairs(cell, np.flatnonzero(~right), to)
        return pd.DataFrame({"a": a, "an": an, "b": b, "bn": bn})

    placed = placed.select("*", cells.alias("at")).select(
        "token", "at.*", "vid", "n", "pos", "indexed", "last", "more", "label", "mark")
    return _marked(placed.groupBy("token", "of", "first", "second").applyInPandas(run, "a long, an long, b long, bn long")
                   .distinct(), marks)


def _directed(pairs):
    """Both directions of the pairs, as (probe, probe_n, vid, n)."""
    way = lambda p, v: pairs.select(F.col(p).alias("probe"), F.col(f"{p}n").alias("probe_n"),
                                    F.col(v).alias("vid"), F.col(f"{v}n").alias("n"))
    return way("a", "b").union(way("b", "a"))


def _probe_cells(pairs):
    """Cells of one probe each, with the sets it is to be compared with; a probe
    of very many has several."""
    pairs = materialise(pairs, "cells")
    blocks = pairs.groupBy("probe").agg(F.ceil(F.sum("n") / CELL_SHINGLES).alias("blocks"))
    cells = pairs.join(materialise(blocks, "blocks"), "probe").withColumn(
        "cell", F.xxhash64("probe", F.pmod(F.xxhash64("vid"), F.col("blocks"))))
    no, yes = F.lit(False), F.lit(True)
    return (cells.select("cell", "vid", no.alias("probe"), yes.alias("built"))
            .union(cells.select("cell", F.col("probe").alias("vid"), yes, no).distinct()))


def _first_cells(pairs):
    """Every set with the one of its candidates that has most candidates itself:
    in a group of near copies that is their original, mostly, and few other pairs
    of the group are left then. Two that have each other are compared once."""
    both = _directed(pairs)
    degree = materialise(both.groupBy("vid").agg(F.count("*").alias("degree")), "degrees")
    best = (both.join(degree.withColumnsRenamed({"vid": "probe", "degree": "order"}), "probe")
            .groupBy("vid", "n").agg(F.max(F.struct("order", "probe", "probe_n")).alias("best"))
            .select("best.*", "vid", "n"))
    once = best.groupBy(F.least("probe", "vid").alias("low"), F.greatest("probe", "vid").alias("high")).agg(
        F.max(F.struct("order", "probe", "probe_n", "vid", "n")).alias("pair"))
    return _probe_cells(once.select("pair.probe", "pair.probe_n", "pair.vid", "pair.n"))


def _other_cells(pairs, labels):
    """The pairs of different classes, each with the end of more such pairs as
    the probe."""
    of = lambda s: labels.select(F.col("vertex").alias(s), F.col("label").alias(f"label_{s}"))
    left = materialise(pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
                       .where("coalesce(label_a, a) <> coalesce(label_b, b)").select(*pairs.columns), "left")
    both = _directed(left)
    degree = materialise(both.groupBy("vid").agg(F.count("*").alias("degree")), "degrees")
    of = lambda s: degree.select(F.col("vid").alias(s), F.col("degree").alias(f"{s}_degree"))
    chosen = (both.join(of("probe"), "probe").join(of("vid"), "vid")
              .where(F.struct("probe_degree", "probe") > F.struct("vid_degree", "vid")))
    return _probe_cells(chosen.select("probe", "probe_n", "vid", "n"))


def linked_classes(df):
    """doc_id, n_shingles and component_id of every row.

    A document without words, or with a null text, has no shingles and is linked
    with nothing, not even with another such; its component is its own doc_id.
    Documents of equal sets are one vertex and linked. A row without doc_id takes
    part; a component of such rows only has no id. Rows are returned as often as
    they occur, an empty table gives none. Other columns are not looked at.
    """
    docs = df.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    bits = frequent_filter(docs)
    listed = materialise(_listed(docs, bits), "listed")
    sets = materialise(
        listed.where("n > 0").groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.min(F.when(F.col("mark").isNotNull(), F.col("row"))).alias("vid")), "distinct")
    members = materialise(_postings(listed, sets), "members")
    marks = listed.where("mark is not null").select(F.col("row").alias("vid"), "mark", "fine")

    def wanted(pairs):
        vids = pairs.select(F.col("a").alias("vid")).union(pairs.select("b")).distinct()
        return materialise(sets.select("vid", "doc_id", "digest", "n").join(vids, "vid"), "wanted")

    # First every set with a hub, and then only sets of different classes: near copies
    # would meet each other at all that they share, of which there are squares.
    pairs = _star_pairs(members, marks)
    some = wanted(pairs)
    data = materialise(_sets_of(docs, some, bits), "sets")
    links = materialise(_joined(_first_cells(pairs), data, some, None), "links")
    labels = components(links)
    known = materialise(_between(members, labels), "between")
    pairs = materialise(_candidates(known, marks).union(_crowded(known, marks)).distinct(), "pairs")
    if pairs.limit(1).count():
        some = wanted(pairs)
        data = materialise(_sets_of(docs, some, bits), "sets")
        links = links.union(materialise(_joined(_other_cells(pairs, labels), data, some, labels), "links"))
        labels = components(links)

    vertex = sets.select("digest", "doc_id", "vid").join(
        labels.withColumnRenamed("vertex", "vid"), "vid", "left").withColumn("label", F.coalesce("label", "vid"))
    vertex = materialise(vertex, "vertices")
    smallest = materialise(vertex.groupBy("label").agg(F.min("doc_id").alias("component_id")), "smallest")
    classes = materialise(vertex.join(smallest, "label").select("digest", "component_id"), "classes")
    return (listed.select("doc_id", "digest", F.col("n").alias("n_shingles")).join(classes, "digest", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
                    .alias("component_id")))


def op11_trie_join(spark, sf_dir):
    return linked_classes(table(spark, sf_dir, "documents"))


ORACLE = r"""
with recursive doc as materialized (
  select row_number() over () as row_no, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') as w
  from documents),
shingle as materialized (
  select distinct row_no, hash(s) as s from (
    select row_no, unnest(case when len(w) = 0 then [] when len(w) < 5 then [w]
                          else list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) end) as s from doc)),
size as materialized (select row_no, count(*) as n from shingle group by row_no),
pair as (
  select a.row_no as x, b.row_no as y, count(*) as common
  from shingle a join shingle b on a.s = b.s and a.row_no <> b.row_no group by all),
link as materialized (
  select x, y from pair join size p on p.row_no = x join size q on q.row_no = y
  where 100 * common >= 80 * (p.n + q.n - common)),
reach as (
  select row_no as x, row_no as y from doc
  union select reach.x, link.y from reach join link on link.x = reach.y)
select d.doc_id, coalesce(any_value(n), 0) as n_shingles, min(e.doc_id) as component_id
from doc d left join size using (row_no) join reach on reach.x = d.row_no join doc e on e.row_no = reach.y
group by d.row_no, d.doc_id
"""
