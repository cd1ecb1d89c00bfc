"""A trie of conversation prefixes, by vertical bitmaps.

Conversations are dealt, in the order of their numbers, to blocks of bounded
size, and their turns to segments of bounded length. In a block's segment every
(position, turn) has a bitmap of the conversations that hold it there. A node is
a bitmap too: the intersection of its parent's with the posting of its turn. A
depth-first walk intersects a node's bitmap with the posting of its lowest
member's next turn, which yields a child, takes the child's members away and goes
on with the rest. Popcounts are the members; what the bitmap of last turns leaves
of a node is the list of conversations that end there.

Blocks give the same node the same key, a digest of the turns on its path, and
are merged by it. A segment begins at the nodes that its conversations enter by,
told apart by the same digest. So neither a long conversation, nor a first turn
that most conversations share, nor copies of one conversation meet in one task.

Sums over subtrees follow the chains of nodes that have the same smallest member:
a chain hangs from a node of another, and totals go up the chains by doubling.
"""

import hashlib

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from labelweave.llm.common import let, table, whole_text, word_count
from labelweave.session import materialise

BASE_EVERY = 20  # conversations that share the first turns of one of them
MOST_SHARED = 4  # one more than the turns that are shared at most
BLOCK_CONVERSATIONS = 1024
SEGMENT_TURNS = 256
_ID = ["k1", "k2", "depth"]


def shared_turns(conv):
    """h: how many turns a rebuilt conversation takes from its base."""
    return (F.crc32(conv.cast("string").cast("binary")) % MOST_SHARED).cast("long")


def base_of(conv):
    return conv - conv % BASE_EVERY


def numbered_turns(df):
    """conv_id, place (from 1, by turn, null first), two hashes of (role, text),
    and the words of the text. Turns of one number follow in the order of a digest
    of role and text.

    Rows are range-partitioned over the whole order and numbered within each
    partition, to which the numbers before it are added: a conversation of most
    rows is dealt to many tasks.
    """
    role, text = whole_text("role"), whole_text("text")
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turns = (df.where("conv_id is not null")
             .select(F.col("conv_id").cast("long"), F.col("turn"), F.md5(whole.cast("binary")).alias("digest"),
                     F.xxhash64(F.lit(1), role, text).alias("t1"), F.xxhash64(F.lit(2), role, text).alias("t2"),
                     word_count(text).alias("words")))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest"]
    turns = materialise(turns.repartitionByRange(*order).withColumn("run", F.spark_partition_id()), "turns")
    runs = turns.groupBy("conv_id", "run").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("run")) - F.col("n")
    runs = materialise(runs.select("conv_id", "run", before.alias("before")).where("before > 0"), "runs")
    within = Window.partitionBy("conv_id", "run").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return (turns.withColumn("within", F.row_number().over(within)).join(runs, ["conv_id", "run"], "left")
            .select("conv_id", (F.col("within") + F.coalesce("before", F.lit(0))).alias("place"), "t1", "t2", "words"))


def blocked(convs):
    """conv_id and block of every conversation; blocks hold consecutive numbers,
    about BLOCK_CONVERSATIONS each, and rise with them."""
    convs = materialise(convs, "convs")
    blocks = max(1, -(-convs.count() // BLOCK_CONVERSATIONS))
    return materialise(convs.repartitionByRange(blocks, "conv_id").withColumn("block", F.spark_partition_id()),
                       "blocks")


def rebuilt(turns):
    """conv_id, block, depth, length, t1, t2, words of the rebuilt conversations'
    turns, and (conv_id, block, length) of all, those without turns included.
    ``turns`` is a written table of numbered_turns."""
    sizes = turns.groupBy("conv_id").agg(F.max("place").alias("own"))
    convs = blocked(sizes.withColumn("h", shared_turns(F.col("conv_id"))))
    base = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    convs = materialise(
        convs.withColumn("base", base_of(F.col("conv_id"))).join(base, "base", "left")
        .withColumn("taken", F.least("h", F.coalesce("base_own", F.lit(0))))
        .withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
        .select("conv_id", "block", "base", "h", "taken", "length"), "convs")
    head = (turns.where(F.col("place") < MOST_SHARED).withColumnRenamed("conv_id", "base")
            .join(convs.where("taken > 0"), "base").where("place <= taken")
            .select("conv_id", "block", F.col("place").alias("depth"), "length", "t1", "t2", "words"))
    own = (turns.join(convs, "conv_id").where("place > h")
           .select("conv_id", "block", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "length",
                   "t1", "t2", "words"))
    return head.unionByName(own), convs.select("conv_id", "block", "length")


def keyed(rows):
    """The rows with p1, p2 (what a turn at its depth adds to the digest of a
    path), their segment, and e1, e2: the digest of the path into the segment.

    Digests are two 64-bit sums without carry (exclusive or) of hashes of (depth,
    turn), so that segments are summed apart.
    """
    rows = rows.withColumns({
        "p1": F.xxhash64("depth", "t1", "t2"), "p2": F.xxhash64("t2", "depth", "t1"),
        "segment": F.floor((F.col("depth") - 1) / SEGMENT_TURNS)}).drop("t1", "t2")
    rows = materialise(rows, "rows")
    last = F.col("segment") < F.floor((F.col("length") - 1) / SEGMENT_TURNS)
    ends = rows.where(last).groupBy("conv_id", "segment").agg(
        F.bit_xor("p1").alias("s1"), F.bit_xor("p2").alias("s2"))
    path = Window.partitionBy("conv_id").orderBy("segment")
    entries = materialise(ends.select("conv_id", (F.col("segment") + 1).alias("segment"),
                                      F.bit_xor("s1").over(path).alias("e1"),
                                      F.bit_xor("s2").over(path).alias("e2")), "entries")
    return rows.join(entries, ["conv_id", "segment"], "left").fillna(0, ["e1", "e2"])


def members(bits):
    """The set positions of a bitmap, in order."""
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def walk(rows):
    """The nodes of one block's segment, as (k1, k2, depth, parent's k1 and k2,
    words, members, bitmap, bitmap of those that end there), and the numbers that
    the bits stand for. ``rows`` are (conv_id, depth, length, p1, p2, words, e1,
    e2) of every turn."""
    numbers = sorted({r[0] for r in rows})
    bit = {c: i for i, c in enumerate(numbers)}
    postings, turn_at, ends, roots = {}, {}, {}, {}
    for conv, depth, length, p1, p2, words, e1, e2 in rows:
        one = 1 << bit[conv]
        turn = postings.setdefault((depth, p1, p2), [0, words])
        turn[0] |= one
        turn_at[bit[conv], depth] = (depth, p1, p2)
        if depth == length:
            ends[depth] = ends.get(depth, 0) | one
        roots[e1, e2] = roots.get((e1, e2), 0) | one
    first = min((r[1] for r in rows), default=1)
    stack = [(e1, e2, first - 1, bits) for (e1, e2), bits in roots.items()]
    while stack:
        k1, k2, depth, rest = stack.pop()
        while rest:
            turn = turn_at.get((((rest & -rest).bit_length() - 1), depth + 1))
            if turn is None:  # goes on in the next segment
                break
            posting, words = postings[turn]
            child = rest & posting
            rest ^= child
            end = child & ends.get(depth + 1, 0)
            c1, c2 = k1 ^ turn[1], k2 ^ turn[2]
            yield c1, c2, depth + 1, k1, k2, words, child, end, numbers
            if child ^ end:
                stack.append((c1, c2, depth + 1, child ^ end))


_PARTIAL = ("k1 long, k2 long, depth long, up1 long, up2 long, words long, n long, conv_id long, block long, "
            "ends string")


def block_nodes(rows):
    """What each block knows of its nodes: members, the smallest of them, and
    the numbers that end there, comma-joined."""
    def run(batch):
        turns = batch[["conv_id", "depth", "length", "p1", "p2", "words", "e1", "e2"]]
        block = int(batch["block"].iloc[0])
        out = []
        for k1, k2, depth, up1, up2, words, bits, end, numbers in walk(list(turns.itertuples(index=False, name=None))):
            low = numbers[(bits & -bits).bit_length() - 1]
            done = ",".join(str(numbers[i]) for i in members(end)) if end else None
            out.append((k1, k2, depth, up1, up2, words, bits.bit_count(), low, block, done))
        return pd.DataFrame(out, columns=[c.split()[0] for c in _PARTIAL.split(", ")])

    return rows.groupBy("block", "segment").applyInPandas(run, _PARTIAL)


def ends_digests(partial):
    """k1, k2, depth, ends_sha256 of the nodes at which conversations end.

    A digest of a list is sequential. Blocks hold rising numbers, so their lists
    are read in the order of blocks, one after the other; no list is ever put
    together.
    """
    def run(batches):
        key, state = None, None
        for batch in batches:
            out = []
            for k1, k2, depth, ends in zip(batch["k1"], batch["k2"], batch["depth"], batch["ends"]):
                if key == (k1, k2, depth):
                    state.update(b"," + ends.encode())
                else:
                    if key:
                        out.append((*key, state.hexdigest()))
                    key, state = (k1, k2, depth), hashlib.sha256(ends.encode())
            yield pd.DataFrame(out, columns=[*_ID, "ends_sha256"])
        if key:
            yield pd.DataFrame([(*key, state.hexdigest())], columns=[*_ID, "ends_sha256"])

    lists = partial.where("ends is not null").select(*_ID, "block", "ends")
    return (lists.repartition(*_ID).sortWithinPartitions(*_ID, "block")
            .mapInPandas(run, "k1 long, k2 long, depth long, ends_sha256 string"))


def merged(partial):
    """One row per node of all blocks, without the root: its key and its
    parent's, words, n_convs, conv_id and ends_sha256 (null without ends)."""
    nodes = partial.groupBy(*_ID).agg(
        F.first("up1").alias("up1"), F.first("up2").alias("up2"), F.first("words").alias("words"),
        F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    return nodes.join(ends_digests(partial), _ID, "left")


def with_parents(nodes):
    """The nodes with parent_conv_id and n_children. ``nodes`` is a written
    table with the root among them."""
    up = nodes.select(F.col("k1").alias("up1"), F.col("k2").alias("up2"), (F.col("depth") + 1).alias("depth"),
                      F.col("conv_id").alias("parent_conv_id"))
    children = nodes.where("depth > 0").groupBy(
        F.col("up1").alias("k1"), F.col("up2").alias("k2"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"))
    return (nodes.join(up, ["up1", "up2", "depth"], "left").join(children, _ID, "left")
            .fillna(0, ["n_children"]).drop("k1", "k2", "up1", "up2"))


def chain_totals(chains):
    """chain and the leaves and saved tokens of the chain and all that hang from
    it. ``chains`` is a written table (chain, up, leaves, saved); up is null for
    the root's.

    After n rounds a chain knows of all chains fewer than 2^n steps below it and
    of its ancestor 2^n steps above.
    """
    while True:
        moving = chains.where("up is not null")
        if not moving.limit(1).count():
            return chains.drop("up")
        got = moving.groupBy(F.col("up").alias("chain")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        further = chains.select(F.col("chain").alias("up"), F.col("up").alias("next"))
        chains = materialise(
            chains.join(further, "up", "left").join(got, "chain", "left")
            .select("chain", F.col("next").alias("up"),
                    (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                    (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "chains")


def with_subtrees(nodes):
    """The nodes with n_leaves and saved_tokens. ``nodes`` is a written table of
    with_parents; a node is known by conv_id and depth."""
    own = nodes.select("conv_id", "depth", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaf"),
                       ((F.col("n_convs") - 1) * F.col("words")).alias("saving"))
    tops = (nodes.groupBy("conv_id").agg(F.min_by(F.struct("parent_conv_id", "depth"), "depth").alias("top"))
            .select(F.col("conv_id").alias("chain"), F.col("top.parent_conv_id").alias("up"),
                    (F.col("top.depth") - 1).alias("hangs")))
    sums = own.groupBy(F.col("conv_id").alias("chain")).agg(F.sum("leaf").alias("leaves"), F.sum("saving").alias("saved"))
    chains = materialise(tops.join(sums, "chain"), "chains")
    totals = chain_totals(chains.select("chain", "up", "leaves", "saved"))
    hung = (chains.where("up is not null").select("chain", "up", "hangs").join(totals, "chain")
            .groupBy(F.col("up").alias("conv_id"), F.col("hangs").alias("depth"))
            .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    here = (own.join(hung, ["conv_id", "depth"], "left")
            .select("conv_id", "depth", (F.col("leaf") + F.coalesce("leaves", F.lit(0))).alias("leaf"),
                    (F.col("saving") + F.coalesce("saved", F.lit(0))).alias("saving"),
                    F.floor(F.col("depth") / SEGMENT_TURNS).alias("segment")))
    here = materialise(here, "sums")
    # Of a chain the nodes from one down: within its segment, and whole segments below.
    down = Window.partitionBy("conv_id", "segment").orderBy(F.col("depth").desc())
    below = Window.partitionBy("conv_id").orderBy(F.col("segment").desc())
    parts = here.groupBy("conv_id", "segment").agg(F.sum("leaf").alias("l"), F.sum("saving").alias("s"))
    parts = parts.select("conv_id", "segment", (F.sum("l").over(below) - F.col("l")).alias("l"),
                         (F.sum("s").over(below) - F.col("s")).alias("s")).where("l > 0 or s > 0")
    sums = (here.withColumns({"wl": F.sum("leaf").over(down), "ws": F.sum("saving").over(down)})
            .join(materialise(parts, "segments"), ["conv_id", "segment"], "left")
            .select("conv_id", "depth", (F.col("wl") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
                    (F.col("ws") + F.coalesce("s", F.lit(0))).alias("saved_tokens")))
    return nodes.join(sums, ["conv_id", "depth"])


def prefix_trie(df):
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Rows without conv_id belong to no conversation and are left out. A null turn
    comes first; null role or text is empty. Rows of equal turn follow in the order
    of a digest of role and text, repeated rows are turns of their own. Without
    conversations there is no node, not even the root.
    """
    turns = materialise(numbered_turns(df.select("conv_id", "turn", "role", "text")), "numbered")
    rows, convs = rebuilt(turns)
    partial = materialise(block_nodes(keyed(rows)), "partial")
    # The root is every conversation's, those without turns end there.
    zero = F.lit(0).cast("long")
    turnless = F.when(F.col("length") == 0, F.col("conv_id"))
    top = (convs.groupBy("block").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"),
                                      F.array_sort(F.collect_list(turnless)).alias("ends"))
           .select(zero.alias("k1"), zero.alias("k2"), zero.alias("depth"),
                   F.lit(None).cast("long").alias("up1"), F.lit(None).cast("long").alias("up2"), zero.alias("words"),
                   "n", "conv_id", F.col("block").cast("long"),
                   F.when(F.size("ends") > 0, F.array_join(F.col("ends").cast("array<string>"), ",")).alias("ends")))
    nodes = materialise(merged(partial.unionByName(top)), "nodes")
    tree = materialise(with_parents(nodes), "tree")
    none = hashlib.sha256(b"").hexdigest()
    return with_subtrees(tree).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def op13_turn_trie(spark, sf_dir):
    return prefix_trie(table(spark, sf_dir, "conversations"))


ORACLE = r"""
with recursive own as materialized (
  select conv_id, [coalesce(role, ''), coalesce(text, '')] as turn, row_number() over (
    partition by conv_id order by turn nulls first,
      md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) as place
  from conversations where conv_id is not null),
crc as (
  select conv_id, list_reduce([4294967295::ubigint] || flatten(list_transform(string_split(conv_id::varchar, ''),
      lambda c: [ascii(c)::ubigint] || list_transform(range(8), lambda i: 256::ubigint))),
      lambda a, x: case when x < 256 then xor(a, x) else xor(a >> 1, 3988292384::ubigint * (a & 1)) end) as c
  from (select distinct conv_id from own)),
heads as (
  select conv_id, conv_id - conv_id % 20 as base, cast(xor(c, 4294967295::ubigint) % 4 as bigint) as h from crc),
rebuilt as (
  select heads.conv_id, 0 as part, place, turn from heads join own on own.conv_id = base and place <= h
  union all
  select heads.conv_id, 1, place, turn from heads join own on own.conv_id = heads.conv_id and place > h),
whole as materialized (
  select h.conv_id, coalesce(turns, []) as turns
  from heads h left join (select conv_id, list(turn order by part, place) as turns from rebuilt group by 1) r
    on r.conv_id = h.conv_id),
node as materialized (
  select turns[1:d] as path, d as depth, min(conv_id) as conv_id, count(*) as n_convs,
         coalesce(string_agg(case when len(turns) = d then conv_id::varchar end, ',' order by conv_id), '') as ends
  from (select *, unnest(range(len(turns) + 1)) as d from whole) group by 1, 2),
family as materialized (
  select n.*, p.conv_id as parent_conv_id, (select count(*) from node c where c.depth = n.depth + 1
           and c.path[1:n.depth] = n.path) as n_children,
         case when n.depth > 0 then len(regexp_extract_all(n.path[-1][2], '[^\x20\x09-\x0D]+')) else 0 end as words
  from node n left join node p on p.depth = n.depth - 1 and p.path = n.path[1:n.depth - 1])
select a.conv_id, a.depth, any_value(a.parent_conv_id) as parent_conv_id, any_value(a.n_convs) as n_convs,
       any_value(a.n_children) as n_children, cast(sum(case when b.n_children = 0 then 1 else 0 end) as bigint) as n_leaves,
       cast(sum((b.n_convs - 1) * b.words) as bigint) as saved_tokens, any_value(sha256(a.ends)) as ends_sha256
from family a join family b on b.depth >= a.depth and b.path[1:a.depth] = a.path
group by a.conv_id, a.depth
"""
