"""Near-duplicate documents by Order MinHash, verified by banded alignment.

The k-mers of a text are its runs of five words, each labelled with how often it
occurred before. For every hash function the sketch takes the few labelled k-mers
of the smallest hashes and keeps their order in the text, so that two sketches
agree where texts share k-mers in the same order. Texts that agree in a sketch
are candidates. A candidate pair is verified by aligning its words within a band
that holds every alignment of the required edit similarity: aligned words over
the words of the longer text, at least 0.8. Classes are the connected components
of the links.
"""

import hashlib
from math import ceil

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from labelweave.llm.common import table, whole_text, word_array
from labelweave.session import materialise

KMER_WORDS = 5
# At a share s of equal k-mers two sketches agree with about s cubed; of pairs
# with s = 0.5 (about seven per cent of the words edited) 998 in 1,000 meet.
SKETCHES = 48
SKETCH_KMERS = 3
SMALL_BUCKET = 32  # texts that are compared with each other; more are refined
CELL_TEXTS = 2048  # at most about so many texts of a large bucket are compared with as many others in a task
CELL_WORDS = 1 << 21  # of them, about; a longer text is alone
SIMILARITY = (4, 5)  # 0.8 as a fraction
_MARK_BITS = 2048
_MANY = 20_000  # k-mers beyond which hash functions are applied one by one
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x):
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


_SEEDS = _mixed(np.arange(1, 4097, dtype=np.uint64) * _ODD)


def words_of(text):
    """Words as bytes: what ASCII blanks separate."""
    return text.encode().split()


def word_hashes(words):
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)


def kmer_hashes(hashes, k=KMER_WORDS):
    """64-bit hash of every run of k words; a shorter text is a single k-mer."""
    if 0 < len(hashes) < k:
        hashes = np.concatenate([hashes, np.zeros(k - len(hashes), np.uint64)])
    count = max(0, len(hashes) - k + 1)
    out = np.zeros(count, np.uint64)
    for j in range(k):
        out += hashes[j:j + count] * _SEEDS[j]
    return _mixed(out)


def labelled(kmers):
    """K-mers told apart from their earlier occurrences."""
    order = np.argsort(kmers, kind="stable")
    ordered = kmers[order]
    fresh = np.ones(len(kmers), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    if fresh.all():
        return kmers
    at = np.arange(len(kmers))
    seen = np.empty(len(kmers), np.uint64)
    seen[order] = at - np.maximum.accumulate(np.where(fresh, at, 0))
    return np.where(seen > 0, _mixed(kmers + seen * _ODD), kmers)


def sketch(kmers, sketches=SKETCHES, size=SKETCH_KMERS):
    """One 64-bit number per sketch, of its k-mers in the order of the text."""
    marks = labelled(kmers)
    n, size = len(marks), min(size, len(marks))
    out = np.empty(sketches, np.uint64)
    step = sketches if n <= _MANY else 1
    for first in range(0, sketches, step):
        seeds = _SEEDS[100 + first:100 + first + step, None]
        hashes = (marks[None, :] ^ seeds) * (seeds | np.uint64(1))
        least = (np.argpartition(hashes, size - 1, axis=1)[:, :size] if size < n
                 else np.broadcast_to(np.arange(n), (step, n)))
        chosen = marks[np.sort(least, axis=1)]
        key = _SEEDS[200 + first:200 + first + step].copy()
        for j in range(size):
            key = _mixed(key + chosen[:, j] * _SEEDS[300 + j])
        out[first:first + step] = key
    return out.view(np.int64)


def _needed(na, nb):
    """Aligned words from which texts of so many words are similar."""
    over, under = SIMILARITY
    return -(-over * max(na, nb) // under)


def aligned_words(a, b):
    """Length of the longest alignment of equal words within the band, or 0 if
    it cannot be long enough.

    An alignment of the needed length leaves at most ``spare`` words of either
    text out, so it never strays further than that from the diagonal. Rows of
    the alignment table are bit vectors: a column whose length grows has a zero.
    """
    na, nb = len(a), len(b)
    need = _needed(na, nb)
    if min(na, nb) < need:
        return 0
    kinds, counts = np.unique(a, return_counts=True)
    kinds_b, counts_b = np.unique(b, return_counts=True)
    _, at_a, at_b = np.intersect1d(kinds, kinds_b, assume_unique=True, return_indices=True)
    if np.minimum(counts[at_a], counts_b[at_b]).sum() < need:
        return 0
    short = min(na, nb)
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - short:][::-1] != b[len(b) - short:][::-1])
    tail = int(differ[0]) if len(differ) else short
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    spare = max(na, nb) - need
    places = {}
    for j, word in enumerate(b.tolist()):
        places[word] = places.get(word, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for i, word in enumerate(a.tolist()):
        found = places.get(word, 0)
        if not found:
            continue
        low = max(0, i - spare)
        found = found >> low << low & (1 << i + spare + 1) - 1
        taken = row & found
        row = ((row + taken) | (row - taken)) & full
    return head + tail + len(b) - row.bit_count()


def similar(a, b):
    return len(a) > 0 and len(b) > 0 and aligned_words(a, b) >= _needed(len(a), len(b))


def mark(words):
    """Hashed words in 2048 bits, each the parity of the words it stands for: two
    texts differ in at least as many words as their marks in bits."""
    odd = np.bincount((words & (_MARK_BITS - 1)).astype(np.int64), minlength=_MARK_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def possible_pairs(vids, words, labels, marks, left, right):
    """Pairs (a, b) of different labels, one at ``left``, one at ``right``, whose
    numbers of words and marks do not forbid the similarity."""
    found = [np.stack([np.minimum(vids[p], vids[to]), np.maximum(vids[p], vids[to])])
             for p, to in _possible(words, labels, marks, left, right)]
    return np.unique(np.concatenate([np.empty((2, 0), np.int64), *found], axis=1), axis=1)


def _possible(words, labels, marks, left, right):
    """For each place at ``left`` (place, those at ``right``) of such pairs, by the
    bits in which their marks differ."""
    over, under = SIMILARITY
    marks = np.frombuffer(b"".join(marks), np.uint64).reshape(-1, _MARK_BITS // 64)
    right = right[np.argsort(words[right], kind="stable")]
    sizes, right_marks = words[right], marks[right]
    low = np.searchsorted(sizes, -(-over * words[left] // under), "left")
    high = np.searchsorted(sizes, under * words[left] // over, "right")
    for i, p in enumerate(left.tolist()):
        at = slice(low[i], high[i])
        differ = np.bitwise_count(right_marks[at] ^ marks[p]).sum(axis=1, dtype=np.int64)
        spare = words[p] + sizes[at] - 2 * -(-over * np.maximum(words[p], sizes[at]) // under)
        keep = (differ <= spare) & (labels[right[at]] != labels[p])
        yield p, right[at][keep][np.argsort(differ[keep], kind="stable")]


def cell_links(nth, vids, words, labels, data, keys, left, right):
    """Links (a, b) that connect every two classes of a bucket between which a text
    at ``left`` and one at ``right`` are similar. ``keys`` are all sketches of the
    texts; a pair is compared in the bucket of the first that agrees, ``nth``."""
    root = {label: label for label in labels.tolist()}

    def find(label):
        while root[label] != label:
            root[label] = label = root[root[label]]
        return label

    texts, links = [np.frombuffer(d, np.uint32) for d in data], []
    for p, to in _possible(words, labels, [mark(t) for t in texts], left, right):
        to = to[~(keys[to, :nth] == keys[p, :nth]).any(axis=1)]
        for q in (to[vids[to] > vids[p]] if left is right else to).tolist():
            a, b = find(labels[p]), find(labels[q])
            if a != b and similar(texts[p], texts[q]):
                root[max(a, b)] = min(a, b)
                links.append((vids[p], vids[q]))
    return links


# On Spark

def _sketched(docs):
    """doc_id, digest and number of the words, sketch; no digest without words."""
    def run(batches):
        for batch in batches:
            rows = []
            for text in batch["text"]:
                words = words_of(text)
                if words:
                    keys = sketch(kmer_hashes(word_hashes(words)))
                    rows.append((hashlib.md5(b" ".join(words)).digest(), len(words), keys))
                else:
                    rows.append((None, 0, None))
            out = pd.DataFrame(rows, columns=["digest", "words", "keys"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64"))
            yield out

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInPandas(
        run, "doc_id long, digest binary, words long, keys array<long>")


def _words_of(docs, wanted):
    """vid and hashed words (32 bits each) of the wanted vid, doc_id and digest.
    The list of wanted texts grows with the corpus and is never broadcast."""
    def run(batches):
        for batch in batches:
            rows = []
            for vid, digest, text in zip(batch["vid"], batch["digest"], batch["text"]):
                words = words_of(text)
                if hashlib.md5(b" ".join(words)).digest() == bytes(digest):
                    rows.append((vid, (word_hashes(words) >> np.uint64(32)).astype(np.uint32).tobytes()))
            yield pd.DataFrame(rows, columns=["vid", "data"]).astype({"vid": "int64"})

    texts = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    return (texts.join(wanted.hint("merge"), "doc_id").select("vid", "digest", "text")
            .mapInPandas(run, "vid long, data binary").dropDuplicates(["vid"]))


def _verified(pairs, words):
    """The pairs (a, b) of vertices whose texts are similar."""
    def run(batches):
        for batch in batches:
            hold = [similar(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32))
                    for x, y in zip(batch["data_a"], batch["data_b"])]
            yield batch.loc[hold, ["a", "b"]]

    side = lambda s: words.select(F.col("vid").alias(s), F.col("data").alias(f"data_{s}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(run, "a long, b long")


def components(links):
    """vertex and label (the smallest vertex of its component) of every vertex
    of a written table of links (a, b).

    Every vertex points to its smallest neighbour, if smaller than itself;
    pointers jump until they reach the roots, and the links between roots are
    the next, at most half as large graph. The driver sees counts.
    """
    labels, edges = None, links.where("a <> b").select("a", "b")
    while True:
        both = edges.union(edges.select("b", "a"))
        roots = materialise(both.groupBy(F.col("a").alias("vertex")).agg(F.min("b").alias("low")).select(
            "vertex", F.least("vertex", "low").alias("label")), "roots")
        while True:
            up = roots.select(F.col("vertex").alias("label"), F.col("label").alias("up"))
            jumped = materialise(roots.join(up, "label").select(
                "vertex", F.col("up").alias("label"), (F.col("up") < F.col("label")).alias("moved")), "roots")
            done = not jumped.where("moved").limit(1).count()
            roots = jumped.drop("moved")
            if done:
                break
        labels = roots if labels is None else materialise(
            labels.join(roots.select(F.col("vertex").alias("label"), F.col("label").alias("up")), "label", "left")
            .select("vertex", F.coalesce("up", "label").alias("label")), "labels")
        end = lambda s: roots.select(F.col("vertex").alias(s), F.col("label").alias(f"root_{s}"))
        edges = materialise(edges.join(end("a"), "a").join(end("b"), "b").where("root_a <> root_b").select(
            F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct(), "links")
        if not edges.limit(1).count():
            return labels


def _within_size(a, b):
    """No pair outside this can reach the similarity: with every word of the
    shorter aligned, too much of the longer is left."""
    over, under = SIMILARITY
    return (under * a >= over * b) & (under * b >= over * a)


def _untested(pairs, tested):
    return materialise(pairs.distinct().join(tested, ["a", "b"], "left_anti") if tested else pairs.distinct(), "pairs")


def _star_pairs(members, order, bucket="key"):
    """Pairs (a, b) of every member with the hub of its bucket, the largest in
    ``order``, but those whose sizes forbid it or whose texts are of one class."""
    hubs = members.groupBy(bucket).agg(F.max(F.struct(order.alias("order"), "vid", "words", "label")).alias("hub"))
    # Written, for adaptive execution splits a bucket of very many texts only
    # where both sides of the join are plain.
    return (members.join(materialise(hubs, "hubs"), bucket).where("label <> hub.label")
            .where(_within_size(F.col("words"), F.col("hub.words")))
            .select(F.least("vid", "hub.vid").alias("a"), F.greatest("vid", "hub.vid").alias("b")))


def _small_pairs(members):
    """Pairs (a, b) of different classes in buckets of at most SMALL_BUCKET texts."""
    other = members.select("key", F.col("vid").alias("b"), F.col("words").alias("b_words"), F.col("label").alias("b_label"))
    return (members.join(other, "key").where("vid < b and label <> b_label")
            .where(_within_size(F.col("words"), F.col("b_words"))).select(F.col("vid").alias("a"), "b"))


def _crowded_links(crowded, labels, words, sketches):
    """Links (a, b) of similar texts of different classes in the buckets of
    ``crowded``: all pairs are compared by their marks and aligned where these allow
    it, in cells of two blocks of a bucket. A pair leaves its cell only if it joins
    classes, and is compared in one of the buckets where it meets."""
    def run(key, cell):
        column = lambda c: cell[c].to_numpy(np.int64)
        left, right = (np.flatnonzero(column("block") == at) for at in key[1:])
        right = left if key[1] == key[2] else right
        links = cell_links(int(cell["nth"].iloc[0]), column("vid"), column("words"), column("label"), cell["data"],
                           np.array([np.asarray(k, np.int64) for k in cell["keys"]]), left, right)
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    known = materialise(crowded.join(labels.withColumnRenamed("vertex", "vid"), "vid", "left")
                        .withColumn("label", F.coalesce("label", "vid")), "crowded")
    mixed = known.groupBy("key").agg(F.count("*").alias("size"), F.sum("words").alias("sum"),
                                     (F.min("label") != F.max("label")).alias("open"))
    blocks = materialise(mixed.where("open").select("key", F.ceil(F.greatest(
        F.col("size") / CELL_TEXTS, F.col("sum") / CELL_WORDS)).alias("blocks")), "blocks")
    known = known.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("vid"), F.col("blocks")))
    cells = known.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return (cells.join(words, "vid").join(sketches, "vid")
            .select("key", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
                    "nth", "vid", "words", "label", "block", "data", "keys")
            .groupBy("key", "first", "second").applyInPandas(run, "a long, b long"))


def _merged(labels, found):
    """The labels when new links join classes; only those classes are worked on."""
    of = lambda s: labels.select(F.col("vertex").alias(s), F.col("label").alias(f"label_{s}"))
    between = materialise(found.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")), "links")
    merged = components(between).select(F.col("vertex").alias("was"), F.col("label").alias("now"))
    alone = merged.join(labels, F.col("was") == F.col("vertex"), "left_anti").select(
        F.col("was").alias("vertex"), F.col("now").alias("label"))
    return materialise(labels.join(merged, F.col("label") == F.col("was"), "left").select(
        "vertex", F.coalesce("now", "label").alias("label")).union(alone), "labels")


def near_duplicates(df):
    """doc_id, digest of the words, class_id, and the label of the class (both
    null without words) of every row.

    The class of a document is the smallest doc_id of its component. Equal
    texts (equal in their words) are one vertex. A text without words, or null,
    is like no other, not even another such; its class is its own doc_id. Rows
    are returned as often as they occur.

    A sketch that very many texts share is never expanded to all its pairs. In
    every bucket the text that shares most sketches with others, in a group of
    copies their original, is compared with all its members. Where the texts of a
    bucket are then of several classes, those of a bucket of at most SMALL_BUCKET
    texts are compared with each other. A larger bucket is refined by one more
    sketch, then by two more, by four and so on, which parts texts that only have a
    passage in common, and its parts are compared with a hub of their own and looked
    at again, until no bucket is mixed or all sketches are used. Work is a few
    comparisons per text and sketch, whatever the size of a group.
    """
    docs = df.select("doc_id", "text")
    sketched = materialise(_sketched(docs), "sketches")
    distinct = materialise(
        sketched.where("digest is not null").groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"), F.first("words").alias("words"), F.first("keys").alias("keys"))
        .withColumn("vid", F.monotonically_increasing_id()), "distinct")
    keyed = distinct.select("vid", "words", F.posexplode("keys").alias("nth", "key"))
    shared = materialise(keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "shared")
    members = materialise(keyed.join(shared, "key"), "members")
    degree = materialise(members.groupBy("vid").agg(F.sum("size").alias("degree")), "degree")
    words = materialise(_words_of(docs, distinct.join(degree, "vid").select("vid", "doc_id", "digest")), "words")

    first = members.join(degree, "vid").withColumn("label", F.col("vid"))
    tested = _untested(_star_pairs(first, F.col("degree")), None)
    labels = components(materialise(_verified(tested, words), "links"))
    members, turn, used, crowded = members.select("key", "vid", "words", "nth"), 0, 1, None
    while True:
        known = materialise(members.join(labels.withColumnRenamed("vertex", "vid"), "vid", "left")
                            .withColumn("label", F.coalesce("label", "vid")), "members")
        mixed = materialise(
            known.groupBy("key").agg(F.count("*").alias("size"), (F.min("label") != F.max("label")).alias("open"))
            .where("open").select("key", (F.col("size") > SMALL_BUCKET).alias("large")), "mixed")
        kinds = {r["large"] for r in mixed.groupBy("large").count().collect()}
        if not kinds:
            break
        pairs, turn, open_ = [], turn + 1, known.join(mixed, "key")
        refining = True in kinds and used < SKETCHES
        if turn == 1 and refining:
            crowded = materialise(open_.where("large").select("key", "vid", "words", "nth"), "crowded")
        if False in kinds:
            pairs.append(_small_pairs(materialise(open_.where("not large").select("key", "vid", "words", "label"), "small")))
        if refining:
            more = range(used, min(used + (1 << turn - 1), SKETCHES))
            fine = [F.get("keys", (F.col("nth") + i) % SKETCHES) for i in more]
            used = more.stop
            members = materialise(
                open_.where("large").join(distinct.select("vid", "keys"), "vid")
                .select(F.xxhash64("key", *fine).alias("key"), "vid", "words", "nth", "label"), "refined")
            pairs.append(_star_pairs(members, F.xxhash64("vid", F.lit(turn))))
            members = members.drop("label")
        if not pairs:
            break
        pairs = _untested(pairs[0] if len(pairs) == 1 else pairs[0].union(pairs[1]), tested)
        found = materialise(_verified(pairs, words), "links")
        tested = tested.union(pairs)
        if found.limit(1).count():
            labels = _merged(labels, found)
        if not refining:
            break
    if crowded is not None:
        found = materialise(_crowded_links(crowded, labels, words, distinct.select("vid", "keys")), "links")
        if found.limit(1).count():
            labels = _merged(labels, found)

    vertex = distinct.select("digest", "doc_id", "vid").join(
        labels.withColumnRenamed("vertex", "vid"), "vid", "left").withColumn("label", F.coalesce("label", "vid"))
    smallest = vertex.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    classes = materialise(vertex.join(smallest, "label").select("digest", "label", "class_id"), "classes")
    return sketched.select("doc_id", "digest").join(classes, "digest", "left").select(
        "doc_id", "digest", F.coalesce("class_id", "doc_id").alias("class_id"), "label")


def one_of_each(df):
    """The rows of ``df`` without near copies: of a class the smallest doc_id
    stays, once. Of texts without words one stays for each doc_id."""
    classes = near_duplicates(df)
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    gone = classes.where(~same("doc_id", "class_id")).select(F.col("doc_id").alias("__id")).distinct()
    repeated = materialise(df.groupBy(F.col("doc_id").alias("__id")).count().where("count > 1").select("__id"),
                           "repeated")
    if not repeated.limit(1).count():
        return df.join(gone, same("doc_id", "__id"), "left_anti")
    # A number that several rows bear: their texts tell which class each is of.
    once = df.join(repeated, same("doc_id", "__id"), "left_anti").join(gone, same("doc_id", "__id"), "left_anti")
    words = word_array(whole_text())
    several = df.join(repeated, same("doc_id", "__id"), "left_semi").withColumn(
        "__digest", F.when(F.size(words) > 0, F.unhex(F.md5(F.array_join(words, " ").cast("binary")))))
    stays = classes.where(same("doc_id", "class_id")).select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__of"), F.col("label").alias("__label")).distinct()
    kept = several.join(stays, same("doc_id", "__id") & same("__digest", "__of")).dropDuplicates(["__id", "__label"])
    return once.unionByName(kept.select(*df.columns))


def op5_order_minhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")
